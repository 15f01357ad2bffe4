"""Secret scans by multipart credential linking, in DataFrame expressions alone.

Parts of credentials are found by pattern: identifiers, secrets and endpoints.
Those with a form of their own (``assign``, ``access``, ``hex``) are reported
as they are.  The weak ones (``login``, ``token``, ``endpoint``) mean little
alone: they are interval-joined with the other parts of the same text and
reported only when the parts that complement them lie within SCOPE characters:
a login wants a secret near it, a token an identifier, an endpoint both.

Positions are code points, the end exclusive.  A part's place is the length of
all that lies before it: the text between the matches (``split``) and the
matches (``regexp_extract_all``) are summed in turn, by a window over the parts
of one text.  Parts are dealt into cells of SCOPE characters for the join, so a
long text with many parts makes no pairs beyond its neighbourhoods.

Defined cases: null text counts as empty and has no parts; rows with equal
doc_id and text are scanned once and each reported; an empty table gives an
empty result.  ``redact`` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

#: fixed values: the agreed patterns, one group for the value where its length counts.
#: Runs shorter than the least length cannot hold a longer match, so the length is in the pattern.
ASSIGN = ("(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: weak parts, as chosen here
LOGIN = ("(?:[Uu]ser(?:_?[Nn]ame|_?[Ii][Dd])?|USER|[Ll]ogin|LOGIN|[Cc]lient_?[Ii][Dd]|CLIENT_ID"
         "|[Aa]ccount_?[Ii][Dd])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9@._+-]+)")
TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = ("(?:https?|ftp|sftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]+)"
            "://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+")

BASE = ("assign", "access", "hex")
WEAK = ("login", "token", "endpoint")
KINDS = BASE + WEAK
ROLE = {"assign": "secret", "hex": "secret", "token": "secret",
        "access": "identifier", "login": "identifier", "endpoint": "endpoint"}
SCOPE = 200
PLACEHOLDER = "[SECRET]"
KEY = ["doc_id", "text_hash", "text_length"]


def _key(frame: DataFrame) -> list[Column]:
    text = F.coalesce(frame["text"], F.lit(""))
    return [frame["doc_id"], F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_length")]


def _matches(text: Column, pattern: str, good) -> Column:
    """Per match in turn: (gap before it, its length, whether it counts); null
    where the pattern is not in the text at all."""
    pair = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("len"),
                                    good(match).alias("good")))
    return F.when(text.rlike(pattern), F.filter(pair, lambda m: m["len"].isNotNull()))


def parts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its key and ``found``, the matches by kind."""
    text = F.coalesce(docs["text"], F.lit(""))
    yes = lambda m: F.lit(True)
    mixed = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    by_kind = {
        "assign": (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8),
        "access": (ACCESS, yes), "hex": (HEX, yes),
        "login": (LOGIN, lambda m: F.length(F.regexp_extract(m, LOGIN, 1)) >= 3),
        "token": (TOKEN, mixed), "endpoint": (ENDPOINT, yes)}
    found = F.array(*[F.struct(F.lit(i).alias("kind"), _matches(text, p, good).alias("matches"))
                      for i, (p, good) in enumerate(by_kind[k] for k in KINDS)])
    return docs.select(*_key(docs), F.filter(
        found, lambda k: F.exists(F.coalesce(k["matches"], F.array()), lambda m: m["good"])).alias("found"))


def spans(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per reported span: key, kind (its place in KINDS), start, end.

    ``found`` is what :func:`parts` gives; rows with equal keys count once.
    """
    hits = found.filter(F.size("found") > 0).dropDuplicates(KEY)
    rows = (hits.select(*KEY, F.explode("found").alias("k"))
            .select(*KEY, "k.kind", F.posexplode("k.matches").alias("at", "m")))
    upto = Window.partitionBy(*KEY, "kind").orderBy("at")
    rows = (rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(upto).cast("long"))
            .filter("m.good")
            .select(*KEY, "kind", (F.col("end") - F.col("m.len")).alias("start"), "end"))
    rows = materialise(rows, "secret-parts")
    strong, weak = rows.filter(F.col("kind") < len(BASE)), rows.filter(F.col("kind") >= len(BASE))
    # a weak span inside a reported one says nothing new
    role = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLE[k])]), F.col("kind"))
    near = (rows.withColumn("role", role)
            .select(*[F.col(c).alias(f"o_{c}") for c in (*KEY, "kind", "start", "end", "role")])
            .withColumn("cell", F.explode(F.sequence(F.floor((F.col("o_start") - scope) / scope),
                                                     F.floor((F.col("o_end") + scope) / scope)))))
    asking = weak.withColumn("role", role).withColumn("cell", F.floor(F.col("start") / scope))
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    joined = asking.join(near, same & (asking["cell"] == near["cell"])
                         & (F.col("o_start") < F.col("start") + scope) & (F.col("o_end") > F.col("start") - scope))
    has = lambda r: F.max(F.col("o_role") == r)
    inside = F.max((F.col("o_kind") < len(BASE)) & (F.col("o_start") < F.col("end")) & (F.col("o_end") > F.col("start")))
    linked = (joined.groupBy(*KEY, "kind", "start", "end", "role")
              .agg(has("identifier").alias("identifier"), has("secret").alias("secret"), inside.alias("inside"))
              .filter(~F.col("inside") & F.when(F.col("role") == "identifier", F.col("secret"))
                      .when(F.col("role") == "secret", F.col("identifier"))
                      .otherwise(F.col("secret") & F.col("identifier"))))
    columns = [*KEY, "kind", "start", "end"]
    return strong.select(*columns).unionByName(linked.select(*columns))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: its key and ``spans``, an array of (start, kind,
    end) in order of start, then of kind as listed in KINDS."""
    found = materialise(parts(docs), "secret-matches")
    lists = spans(found, scope).groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return _join_key(found.select(*KEY), lists).withColumn("spans", F.coalesce(
        "spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))


def _join_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on KEY, where a null doc_id equals a null doc_id."""
    renamed = right.select(*[F.col(c).alias(f"r_{c}") if c in KEY else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return left.join(renamed, same, "left").drop(*[f"r_{c}" for c in KEY])


def listed(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, scope: int = SCOPE, placeholder: str = PLACEHOLDER) -> DataFrame:
    """``docs`` with every reported span (overlapping ones as one) replaced;
    ``n_chars``, where there is one, follows the new text."""
    found = materialise(parts(docs), "secret-matches")
    at = Window.partitionBy(*KEY).orderBy("start", "end")
    rows = spans(found, scope).withColumn("before", F.max("end").over(
        at.rowsBetween(Window.unboundedPreceding, -1)))
    rows = (rows.withColumn("opens", (F.col("before").isNull() | (F.col("start") >= F.col("before"))).cast("int"))
            .withColumn("run", F.sum("opens").over(at)))
    runs = rows.groupBy(*KEY, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    lists = runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__runs"))
    keyed = [F.col(c).alias(f"__{c}") for c in KEY]
    lists = lists.select(*keyed, "__runs")
    left = docs.select(*docs.columns, *[k.alias(f"__l{i}") for i, k in enumerate(_key(docs))])
    same = F.lit(True)
    for i, c in enumerate(KEY):
        same = same & F.col(f"__l{i}").eqNullSafe(F.col(f"__{c}"))
    # the text between the runs, each piece from the end of the run before
    runs_, text = F.col("__runs"), docs["text"]
    edges = F.concat(F.transform(runs_, lambda r: r["end"]), F.array(F.length(text).cast("long")))
    starts = F.concat(F.transform(runs_, lambda r: r["start"]), F.array(F.length(text).cast("long")))
    pieces = F.zip_with(F.concat(F.array(F.lit(0).cast("long")), F.slice(edges, 1, F.size(runs_))), starts,
                        lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    joined = left.join(lists, same, "left").withColumn(
        "text", F.when(runs_.isNull(), F.col("text")).otherwise(F.array_join(pieces, placeholder)))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(runs_.isNull(), F.col("n_chars"))
                                   .otherwise(F.length("text")).cast("long"))
    return joined.select(*docs.columns)
