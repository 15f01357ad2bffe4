"""Landing-sheet vocabulary: header rename maps and canonical column lists.

Headers are matched by (normalised) name, never by position; absent
columns become NULL, extra columns are dropped.
"""

from __future__ import annotations

# Published header -> canonical column, per sheet.
REGISTROS_MAP = {
    "Open Contracting ID": "OCID",
    "Entrega compilada:ID de Entrega": "ID_ENTREGA",
    "Entrega compilada:Etiqueta de entrega": "ETIQUETA_ENTREGA",
    "Entrega compilada:Fecha de entrega": "FECHA_ENTREGA",
    "compiledrelease/publisheddate": "FECHA_PUBLICACION",
    "Entrega compilada:Comprador:ID de Organización": "ID_COMPRADOR_ORIGINAL",
    "Entrega compilada:Comprador:Nombre de la Organización": "NOMBRE_COMPRADOR_ORIGINAL",
    "Entrega compilada:Licitación:ID de licitación": "ID_LICITACION",
    "Entrega compilada:Licitación:Título de la licitación": "TITULO_LICITACION",
    "Entrega compilada:Licitación:Descripción de la licitación": "DESCRIPCION_LICITACION",
    "Entrega compilada:Licitación:Entidad contratante:ID de Organización":
        "ID_ENTIDAD_CONTRATANTE_ORIGINAL",
    "Entrega compilada:Licitación:Entidad contratante:Nombre de la Organización":
        "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL",
    "compiledrelease/tender/datepublished": "FECHA_PUBLICACION_LICITACION",
    "Entrega compilada:Licitación:Método de contratación": "METODO_CONTRATACION",
    "Entrega compilada:Licitación:Detalles del método de contratación":
        "DETALLE_METODO_CONTRATACION",
    "Entrega compilada:Licitación:Categoría principal de contratación": "CATEGORIA_PRINCIPAL",
    "Entrega compilada:Licitación:Categorías adicionales de contratación":
        "CATEGORIAS_ADICIONALES",
    "Entrega compilada:Licitación:Valor:Monto": "MONTO_LICITACION",
    "Entrega compilada:Licitación:Valor:Moneda": "MONEDA_LICITACION",
    "Entrega compilada:Licitación:Valor:Nombre de Moneda": "NOMBRE_MONEDA_LICITACION",
    "compiledrelease/tender/value/amount_pen": "MONTO_LICITACION_PEN",
}

CONTRATOS_MAP = {
    "Open Contracting ID": "OCID",
    "Entrega compilada:ID de Entrega": "ID_ENTREGA",
    "Entrega compilada:Contratos:ID del Contrato": "ID_CONTRATO",
    "Entrega compilada:Contratos:ID de Adjudicación": "ID_ADJUDICACION",
    "Entrega compilada:Contratos:Título del contrato": "TITULO_CONTRATO",
    "Entrega compilada:Contratos:Descripción del contrato": "DESCRIPCION_CONTRATO",
    "Entrega compilada:Contratos:Periodo:Fecha de inicio": "FECHA_INICIO",
    "Entrega compilada:Contratos:Periodo:Fecha de fin": "FECHA_FIN",
    "Entrega compilada:Contratos:Periodo:Duración (días)": "DURACION_DIAS",
    "Entrega compilada:Contratos:Valor:Monto": "MONTO_CONTRATO",
    "Entrega compilada:Contratos:Valor:Moneda": "MONEDA_CONTRATO",
    "Entrega compilada:Contratos:Valor:Nombre de Moneda": "NOMBRE_MONEDA_CONTRATO",
    "Entrega compilada:Contratos:Fecha de firma": "FECHA_FIRMA",
    "Entrega compilada:Contratos:Implementación:Valor final:Monto": "MONTO_FINAL",
    "Entrega compilada:Contratos:Implementación:Valor final:Moneda": "MONEDA_FINAL",
    "Entrega compilada:Contratos:Implementación:Valor final:Nombre de Moneda":
        "NOMBRE_MONEDA_FINAL",
    "Entrega compilada:Contratos:Implementación:Fecha de fin": "FECHA_FIN_IMPLEMENTACION",
}

PROVEEDORES_MAP = {
    "Open Contracting ID": "OCID",
    "Entrega compilada:ID de Entrega": "ID_ENTREGA",
    "Entrega compilada:Adjudicaciones:ID de Adjudicación": "ID_ADJUDICACION",
    "Entrega compilada:Adjudicaciones:Proveedores:ID de Organización": "ID_PROVEEDOR_ORIGINAL",
    "Entrega compilada:Adjudicaciones:Proveedores:Nombre de la Organización":
        "NOMBRE_PROVEEDOR_ORIGINAL",
}

PARTES_MAP = {
    "Open Contracting ID": "OCID",
    "Entrega compilada:ID de Entrega": "ID_ENTREGA",
    "Entrega compilada:Partes involucradas:ID de Entidad": "ID_ORGANIZACION",
    "Entrega compilada:Partes involucradas:Nombre común": "NOMBRE_COMUN_ORIGINAL",
    "Entrega compilada:Partes involucradas:Identificador principal:ID": "IDENTIFICADOR_PRINCIPAL",
    "Entrega compilada:Partes involucradas:Identificador principal:Esquema":
        "ESQUEMA_IDENTIFICADOR",
    "Entrega compilada:Partes involucradas:Identificador principal:Nombre Legal":
        "NOMBRE_LEGAL_ORIGINAL",
    "Entrega compilada:Partes involucradas:Dirección:Dirección": "DIRECCION_ORIGINAL",
    "Entrega compilada:Partes involucradas:Dirección:Localidad": "LOCALIDAD_ORIGINAL",
    "Entrega compilada:Partes involucradas:Dirección:Región": "REGION_ORIGINAL",
    "Entrega compilada:Partes involucradas:Dirección:Departamento": "DEPARTAMENTO_ORIGINAL",
    "Entrega compilada:Partes involucradas:Dirección:País": "PAIS_ORIGINAL",
    "Entrega compilada:Partes involucradas:Punto de contacto:Teléfono": "TELEFONO",
    "Entrega compilada:Partes involucradas:Roles de las partes": "ROLES_ORIGINAL",
    "Entrega compilada:Partes involucradas:Punto de contacto:Correo electrónico": "CORREO",
    "Entrega compilada:Partes involucradas:Punto de contacto:URL": "URL_CONTACTO",
}

# Sheet names of the monthly workbook per dataset.
SHEETS = {
    "registros": "Registros",
    "contratos": "Ent_Contratos",
    "proveedores": "Ent_Adj_Proveedores",
    "partes": "Ent_PartesInvolucradas",
}
# Fixed value: first published year; there is no last one.
FIRST_YEAR = 2022

# Canonical columns in published order (the map values, in order).
REGISTROS_COLUMNS = list(REGISTROS_MAP.values())
CONTRATOS_COLUMNS = list(CONTRATOS_MAP.values())
PROVEEDORES_COLUMNS = list(PROVEEDORES_MAP.values())
PARTES_COLUMNS = list(PARTES_MAP.values())

MAPS = {"registros": REGISTROS_MAP, "contratos": CONTRATOS_MAP,
        "proveedores": PROVEEDORES_MAP, "partes": PARTES_MAP}
COLUMNS = {"registros": REGISTROS_COLUMNS, "contratos": CONTRATOS_COLUMNS,
           "proveedores": PROVEEDORES_COLUMNS, "partes": PARTES_COLUMNS}

LINEAGE = ["ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN"]
