"""PII removal by format-preserving Feistel pseudonyms, in DataFrame expressions.

Numbers and dates that pass their check (card numbers with a right Luhn digit,
telephone numbers by their form, identity numbers with no part of zeros and
no area 666, dates of the calendar, IPv4 addresses with parts up to 255) are replaced by another value of the same
format, by a keyed permutation of all values of that format: equal values get
equal pseudonyms in every document, different ones stay different.  Of a mail
address, which has no fixed format, a keyed hash is left.

The permutation is a Feistel network over digit strings: the two halves of a
number are shifted in turn by a SHA-256 of the key, the round, the length and
the other half, modulo a power of ten, so every round can be undone and digits
stay digits, and known pairs do not give the key away.  Where not all values are
of the format (dates, addresses, identity numbers) the network is applied again until
the value is one of the format, which is still a permutation.  A card's check
digit is computed anew.

The key is an argument: without it pseudonyms cannot be linked to the values.
One pattern of alternatives is matched from left to right; what fails its
check stays as it is.  Groups of digits joined by single blanks or hyphens are
matched as a run, up to the next value of another form, and gone through group
by group: at each the usual forms of a card are tried, then, at the start of the
run or behind a value, the whole rest of it if joined alike, then a telephone
number, then, again only there, the first 19 to 13 digits however joined.  So a
value is found next to others, and a group that begins none is passed alone.
Everything happens within a row: nothing is shuffled.

Defined cases: a null text stays null and has no counts; an empty one stays as
it is; repeated rows get equal results; an empty table gives an empty result.
Columns other than ``text`` (and ``n_chars``, which follows the new text) are
passed through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "date", "ip", "ssn", "card", "phone")
ROUNDS = 8
#: a date's pseudonym is one of so many days from FIRST_DAY (up to 2099-12-31)
FIRST_DAY, DAYS = "1900-01-01", 73049
#: identity numbers: areas 001 to 999 without 666, groups 01 to 99, serials 0001 to 9999
NO_AREA, AREAS, GROUPS, SERIALS = 666, 998, 99, 9999
#: applications of the network after which a walk ends (it ends before, but for one in 10 ** 15 values)
WALK = 64

#: fixed values: the forms, tried in this order at each place
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
PHONE = (r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])")
#: what ends a run: a value of another form, an email whose first part goes on behind the
#: group with other than digits, a telephone number with points
OTHER = "|".join([r"[0-9]+(?!-?[0-9])[A-Za-z0-9._%+-]*@[A-Za-z0-9]", FORMS["date"], FORMS["ip"], FORMS["ssn"],
                  r"[0-9]{3}(?:\.[0-9]{3}[ .-]?|[ -][0-9]{3}\.)[0-9]{4}(?![0-9])"])
GROUP = rf"(?!{OTHER})[0-9]{{1,19}}+(?![0-9])"
FORMS["card"] = rf"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){{12}}){GROUP}(?:[ -]{GROUP})*+"
FORMS["phone"] = PHONE
#: within a run: 19 digits joined singly and the character behind them
RUN_WINDOW = 38
CARDS = [r"^[0-9]{13,19}(?![0-9])", r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
         r"^[0-9]{4}([ -])[0-9]{6}\1[0-9]{5}(?![0-9])"]
JOINED_ALIKE = r"^(?=[0-9](?:[ -]?[0-9]){12,18}$)[0-9]+([ -])[0-9]+(?:\1[0-9]+)*$"
ANY_CARDS = [rf"^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])" for n in range(19, 12, -1)]
ANY = "|".join(FORMS.values())
#: what any of them has
GATE = "[0-9]{2}|@"


def keyed(key: str, *parts: Column) -> Column:
    """A long from 0 to 2 ** 60 - 1: the first 60 bits of SHA-256 of the key and the numbers."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(digits: Column, key: str, back: bool = False) -> Column:
    """Keyed permutation of the digit strings of each length from 1 to 18;
    ``back`` undoes it."""
    sign = -1 if back else 1

    def network(d: Column) -> Column:
        n = F.length(d)
        at = F.floor(n / 2).cast("int")
        start = F.struct(F.coalesce(F.left(d, at).try_cast("long"), F.lit(0).cast("long")).alias("l"),
                         F.right(d, n - at).cast("long").alias("r"),
                         F.rpad(F.lit("1"), at + 1, "0").cast("long").alias("lm"),
                         F.rpad(F.lit("1"), n - at + 1, "0").cast("long").alias("rm"))

        def turn(s: Column, i: Column) -> Column:
            shift = lambda half, mod: F.pmod(keyed(key, i, n, half), mod)
            other = F.when(i % 2 == 0, s["l"]).otherwise(
                F.pmod(s["l"] + sign * shift(s["r"], s["lm"]), s["lm"]))
            right = F.when(i % 2 == 0, F.pmod(s["r"] + sign * shift(s["l"], s["rm"]), s["rm"])).otherwise(s["r"])
            return F.struct(other.alias("l"), right.alias("r"), s["lm"].alias("lm"), s["rm"].alias("rm"))

        order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        return F.aggregate(F.array(*[F.lit(i) for i in order]), start, turn, lambda s: F.concat(
            F.when(at > 0, F.lpad(s["l"].cast("string"), at, "0")).otherwise(""),
            F.lpad(s["r"].cast("string"), n - at, "0")))

    return let(digits, network)


def walked(number: Column, width: int, size: int, key: str) -> Column:
    """Keyed permutation of 0 .. size - 1, where size is at least a third of
    10 ** width: the network is applied until it gives a number below size."""
    def step(s: Column, _: Column) -> Column:
        again = let(feistel(s["v"], key), lambda v: F.struct(v.alias("v"), (v.cast("long") < size).alias("done")))
        return F.when(s["done"], s).otherwise(again)

    start = F.struct(F.lpad(number.cast("string"), width, "0").alias("v"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step, lambda s: s["v"].cast("long"))


def check_digit(digits: Column) -> Column:
    """The digit that, put after ``digits``, makes the Luhn sum a multiple of ten."""
    each = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    worth = lambda x, i: F.when(i % 2 == 0, F.floor(2 * x.cast("int") / 10) + (2 * x.cast("int")) % 10) \
        .otherwise(x.cast("int")).cast("int")
    total = F.aggregate(F.transform(each, worth), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def put_digits(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn by ``digits``, all else kept."""
    return F.array_join(F.zip_with(
        F.split(shape, "[0-9]", -1), F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0)),
        lambda gap, d: F.concat(gap, F.coalesce(d, F.lit("")))), "")


def _body(digits: Column) -> Column:
    """All but the last digit."""
    return F.left(digits, F.length(digits) - 1)


def kind_of(value: Column) -> Column:
    """The kind whose form and check a match of ANY that is no run passes, or null."""
    whole = lambda kind: value.rlike(f"^(?:{FORMS[kind]})$")
    octets = F.forall(F.split(value, "[.]"), lambda x: x.cast("int") <= 255)
    day = F.try_to_date(value, "yyyy-MM-dd")
    return (F.when(value.contains("@"), "email")
            .when(whole("date"), F.when((day >= F.lit(FIRST_DAY)) & (day < F.date_add(F.lit(FIRST_DAY).cast("date"), DAYS)), "date"))
            .when(whole("ip"), F.when(octets, "ip"))
            .when(whole("ssn"), F.when(~value.rlike(f"^(?:000|{NO_AREA})|-00-|0000$"), "ssn"))
            .otherwise("phone"))


def is_run(value: Column) -> Column:
    """Whether a match of ANY is a run of digit groups."""
    return (value.rlike("^[0-9]++(?:[ -][0-9]++)*+$") & ~value.rlike(f"^(?:{FORMS['date']}|{FORMS['ssn']})$"))


def scrub_run(run: Column, key: str) -> Column:
    """(text, card, phone): a run with its values replaced, and how many."""
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    passes = lambda v: (v != "") & let(digits(v), lambda d: check_digit(_body(d)) == F.right(d, F.lit(1)))
    tried = lambda w, forms: F.get(F.filter(F.array(*[F.regexp_extract(w, f, 0) for f in forms]), passes), F.lit(0))

    def step(s: Column, _: Column) -> Column:
        def taken(w: Column) -> Column:
            phone = F.regexp_extract(w, f"^{PHONE}", 0)
            return F.coalesce(
                tried(w, CARDS), F.when(s["fresh"], tried(w, [JOINED_ALIKE])), F.when(phone != "", phone),
                F.when(s["fresh"], tried(w, ANY_CARDS)), F.regexp_extract(w, "^[0-9]+", 0))

        def replaced(v: Column) -> Column:
            phone = v.rlike(f"^{PHONE}$")
            card = ~phone & (F.length(v) >= 13)
            # 13 to 19 digits are a card only if they pass
            card = card & (F.length(digits(v)) >= 13) & passes(v)
            return F.struct(
                F.substring(s["rest"], F.length(v) + 2, F.length(s["rest"])).alias("rest"),
                F.concat(s["text"], F.when(card, pseudonym(v, F.lit("card"), key)).when(phone, pseudonym(v, F.lit("phone"), key))
                         .otherwise(v), F.substring(s["rest"], F.length(v) + 1, F.lit(1))).alias("text"),
                (card | phone).alias("fresh"),
                (s["card"] + card.cast("int")).alias("card"), (s["phone"] + phone.cast("int")).alias("phone"))

        return F.when(s["rest"] == "", s).otherwise(let(let(F.left(s["rest"], F.lit(RUN_WINDOW)), taken), replaced))

    start = F.struct(run.alias("rest"), F.lit("").alias("text"), F.lit(True).alias("fresh"), F.lit(0).alias("card"),
                     F.lit(0).alias("phone"))
    groups = F.size(F.split(run, "[ -]", -1))
    return F.aggregate(F.sequence(F.lit(1), groups), start, step,
                       lambda s: F.struct(s["text"].alias("text"), s["card"].alias("card"), s["phone"].alias("phone")))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """Another value of the kind's format; equal for equal values and keys."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    first = F.lit(FIRST_DAY).cast("date")
    parts = F.split(value, "[.]")
    address = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
    part = F.split(value, "-")
    area = part[0].cast("long")
    person = (((area - F.when(area > NO_AREA, 2).otherwise(1)) * GROUPS + part[1].cast("long") - 1) * SERIALS
              + part[2].cast("long") - 1)
    padded = lambda number, n: F.lpad(number.cast("string"), n, "0")

    def identity(n: Column) -> Column:
        a = F.floor(n / (GROUPS * SERIALS)) + 1
        return F.concat_ws("-", padded(a + F.when(a >= NO_AREA, 1).otherwise(0), 3),
                           padded(F.floor(n / SERIALS) % GROUPS + 1, 2), padded(n % SERIALS + 1, 4))

    octet = lambda a, i: F.shiftright(a, 8 * i).bitwiseAND(F.lit(255)).cast("string")
    return (F.when(kind == "email", F.concat(F.lit("u"), F.left(F.sha2(F.concat(F.lit(key), F.lower(value)), 256), F.lit(16)),
                                             F.lit("@example.invalid")))
            .when(kind == "date", F.date_add(first, walked(
                F.datediff(F.try_to_date(value, "yyyy-MM-dd"), first), 5, DAYS, key).cast("int")).cast("string"))
            .when(kind == "ip", let(walked(address, 10, 1 << 32, key),
                                    lambda a: F.concat_ws(".", *[octet(a, i) for i in (3, 2, 1, 0)])))
            .when(kind == "ssn", let(walked(person, 9, AREAS * GROUPS * SERIALS, key), identity))
            .when(kind == "card", let(feistel(_body(digits), key),
                                      lambda d: put_digits(value, F.concat(d, check_digit(d)))))
            .otherwise(put_digits(value, feistel(digits, key))))


def scrub(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """``docs`` with every validated value replaced; with ``counts`` also
    ``n_<kind>`` columns (long; null for a null text)."""
    text = docs["text"]
    none = F.lit(None).cast("string")
    one_value = lambda v: let(kind_of(v), lambda k: F.struct(
        k.alias("kind"), F.when(k.isNull(), v).otherwise(pseudonym(v, k, key)).alias("text"),
        F.lit(0).alias("card"), F.lit(0).alias("phone")))
    run = lambda v: let(scrub_run(v, key), lambda r: F.struct(
        none.alias("kind"), r["text"].alias("text"), r["card"].alias("card"), r["phone"].alias("phone")))
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
                        lambda v: F.when(is_run(v), run(v)).otherwise(one_value(v)))
    # the explode of one element keeps the matches from being found again for every column
    row = F.explode(F.array(F.struct(F.when(text.rlike(GATE), found).alias("found"),
                                     F.when(text.rlike(GATE), F.split(text, ANY, -1)).alias("gaps"))))
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    one = docs.select(*docs.columns, row.alias("__pii"))
    hits = F.col("__pii.found")
    new = F.when(hits.isNull() | (F.size(hits) == 0), F.col("text")).otherwise(F.array_join(F.zip_with(
        "__pii.gaps", hits, lambda gap, hit: F.concat(gap, F.coalesce(hit["text"], F.lit("")))), ""))
    out = [new.alias("text") if c == "text" else
           F.when(F.col("text").isNull(), F.col(c)).otherwise(F.length(new)).cast("long").alias(c)
           if c == "n_chars" and c not in rest else F.col(c) for c in docs.columns]
    if counts:
        n = lambda k: F.size(F.filter(F.coalesce(hits, F.array()), lambda h: h["kind"] == k))
        in_runs = lambda k: F.aggregate(F.coalesce(hits, F.array()), F.lit(0), lambda a, h: a + h[k])
        out += [F.when(F.col("text").isNotNull(), n(k) + in_runs(k) if k in ("card", "phone") else n(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return one.select(*out)
