"""Format-preserving pseudonyms for private values, in DataFrame functions only.

A value is permuted within its own format by a keyed Feistel network, so equal values stay equal in all
documents, different ones stay different, and the result is valid where the value was: card numbers
keep a right check digit, addresses stay addresses, dates stay dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table

ROUNDS = 8
#: Kinds and how they are written. The first kind that fits at a place takes it.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62}\.){1,8}[A-Za-z]{2,24}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)",
    "date": r"(?<![\d\-/])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d\-/])",
    "ssn": r"(?<![\d\-])(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d\-])",
    "card": r"(?<![\d\-])(?:\d[ \-]?){12,18}\d(?![\d]|-\d)",
    "phone": r"(?<![\d\-])(?:(?:\+\d{1,3}[ .\-]?|1[ .\-])?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\+\d{1,3}[ .\-]?\d{10})(?![\d\-])",
}
#: Digits and separators as far as they go, up to where no other value begins; a card and its neighbours lie in one.
RUN = r"(?<![\d\-])\d[\d \-]{11,}\d(?!\d|-\d|\.\d|[A-Za-z0-9._%+\-]{0,63}@)"
#: Lengths of cards in the order in which they are looked for within a run.
CARD_DIGITS = (16, 15, 14, 13, 19, 18, 17)
#: Dates are permuted among the 73,050 days from 1900-01-01; the last lies beyond 2099 and is permuted on.
DAYS = (150, 487)


def _let(value: Column, body) -> Column:
    """`body` of the value, which is computed once: inside lambdas Spark does not share expressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _draw(key: Column, i: Column, *what) -> Column:
    """A keyed number below 2**60 for round `i`."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, i.cast("string"), *what).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _permuted(value: Column, a: Column, b: Column, key: Column, tweak: str) -> Column:
    """A keyed permutation of 0 .. a*b - 1: halves of a and of b values take turns in shifting each other."""
    start = F.struct(F.floor(value / b).cast("long").alias("x"), (value % b).cast("long").alias("y"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        start,
        lambda s, i: F.struct(
            F.when(i % 2 == 0, (s["x"] + _draw(key, i, F.lit(tweak), s["y"].cast("string"))) % a).otherwise(s["x"]).alias("x"),
            F.when(i % 2 == 1, (s["y"] + _draw(key, i, F.lit(tweak), s["x"].cast("string"))) % b).otherwise(s["y"]).alias("y"),
        ),
        lambda s: s["x"] * b + s["y"],
    )


def _number(digits: Column, start, length) -> Column:
    return F.coalesce(F.substring(digits, start, length).try_cast("long"), F.lit(0).cast("long"))


def _digits_permuted(digits: Column, key: Column, tweak: str) -> Column:
    """A string of 2 to 18 digits as another of the same length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    b = F.pow(F.lit(10.0), n - left).cast("long")  # a power of ten to the ninth at most, so exact
    value = _number(digits, F.lit(1), left) * b + _number(digits, left + 1, n - left)
    return F.lpad(_permuted(value, F.pow(F.lit(10.0), left).cast("long"), b, key, tweak).cast("string"), n, "0")


def _luhn(digits: Column) -> Column:
    """The sum that is a multiple of ten for a right card number."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda s, i: s + F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int") + 1) * ((n - i) % 2) + F.substring(digits, i, F.lit(1)).cast("int") * (1 - (n - i) % 2),
    )


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced, in order, by `digits`; all other characters stay."""

    def step(new: Column, acc: Column, i: Column) -> Column:
        c = F.substring(shape, i, F.lit(1))
        digit = c.between("0", "9")
        return F.struct(F.concat(acc["s"], F.when(digit, F.substring(new, acc["k"], F.lit(1))).otherwise(c)).alias("s"), (acc["k"] + digit.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return _let(digits, lambda new: F.aggregate(F.sequence(F.lit(1), F.length(shape)), start, lambda acc, i: step(new, acc, i), lambda acc: acc["s"]))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _shifted(s: Column, other: Column, key: Column, i: Column) -> Column:
    """Letters and digits of `s` moved on within their own kind, by amounts drawn from `other`."""
    def moved(k: Column) -> Column:
        c = F.substring(s, k, F.lit(1))
        step = F.conv(F.substring(F.sha2(F.concat_ws("|", key, i.cast("string"), k.cast("string"), other).cast("binary"), 256), 1, 8), 16, 10).cast("long")
        low, up, digit = F.instr(F.lit(_LETTERS), c), F.instr(F.lit(_LETTERS.upper()), c), F.instr(F.lit("0123456789"), c)
        return F.when(low > 0, F.substring(F.lit(_LETTERS), ((low - 1 + step) % 26 + 1).cast("int"), F.lit(1))).when(up > 0, F.substring(F.lit(_LETTERS.upper()), ((up - 1 + step) % 26 + 1).cast("int"), F.lit(1))).when(digit > 0, ((digit - 1 + step) % 10).cast("string")).otherwise(c)

    return F.when(F.length(s) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), moved), "")).otherwise(s)


def _name_permuted(name: Column, key: Column) -> Column:
    """A name as another of the same form: letters stay letters of their case, digits stay digits."""
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(F.substring(name, F.lit(1), half).alias("x"), F.substring(name, half + 1, F.length(name)).alias("y"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        start,
        lambda s, i: F.struct(F.when(i % 2 == 0, _shifted(s["x"], s["y"], key, i)).otherwise(s["x"]).alias("x"), F.when(i % 2 == 1, _shifted(s["y"], s["x"], key, i)).otherwise(s["y"]).alias("y")),
        lambda s: F.concat(s["x"], s["y"]),
    )


def _card(m: Column, key: Column) -> Column:
    """Another card number with a right check digit; a number without one is no card and stays."""

    def checked(body: Column) -> Column:
        due = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
        return _refilled(m, F.concat(body, due.cast("string")))

    def renamed(digits: Column) -> Column:
        body = _digits_permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return F.when(_luhn(digits) % 10 == 0, _let(body, checked)).otherwise(m)

    return _let(F.regexp_replace(m, "[^0-9]", ""), renamed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _pieces(text: Column, pattern: str) -> Column:
    """The text as an array of (s, value): what the pattern matches and what lies between."""

    def woven(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(g.alias("s"), F.lit(False).alias("value")))
        values = F.transform(found, lambda v: F.struct(v.alias("s"), F.lit(True).alias("value")))
        return F.flatten(F.zip_with(gaps, values, lambda g, v: F.when(v.isNull(), F.array(g)).otherwise(F.array(g, v))))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), woven)


def _parted(run: Column) -> Column:
    """A run as pieces: it is one card, or has cards of whole groups of digits, from left to right, and
    between them dates, social security numbers and phones."""
    rest_of = "|".join(KINDS[k] for k in ("date", "ssn", "phone"))

    def valid(c: Column) -> Column:
        return F.when(c != "", F.when(_luhn(_digits(c)) % 10 == 0, c))

    def card_at(p: Column) -> Column:
        rest = F.substring(run, p, F.lit(38))  # 19 digits, 18 separators and what follows
        return F.coalesce(*[_let(F.regexp_extract(rest, rf"^(?:\d[ \-]?){{{n - 1}}}\d(?!\d)", 0), valid) for n in CARD_DIGITS], F.lit(""))

    def step(acc: Column, p: Column) -> Column:
        begins = (p >= acc["next"]) & F.substring(run, p, F.lit(1)).between("0", "9") & ((p == 1) | ~F.substring(run, p - 1, F.lit(1)).between("0", "9"))

        def taken(card: Column) -> Column:
            cut = F.array(F.struct(acc["next"].alias("from"), p.alias("at"), card.alias("card")))
            return F.when(card == "", acc).otherwise(F.struct((p + F.length(card)).alias("next"), F.concat(acc["cuts"], cut).alias("cuts")))

        return F.when(begins, _let(card_at(p), taken)).otherwise(acc)

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<from:int,at:int,card:string>>").alias("cuts"))

    def cut_up(acc: Column) -> Column:
        some = F.transform(acc["cuts"], lambda c: F.concat(_pieces(F.substring(run, c["from"], c["at"] - c["from"]), rest_of), F.array(F.struct(c["card"].alias("s"), F.lit(True).alias("value")))))
        return F.concat(F.flatten(some), _pieces(F.substring(run, acc["next"], F.length(run)), rest_of))

    whole = run.rlike(f"^(?:{KINDS['card']})$") & (_luhn(_digits(run)) % 10 == 0)
    return F.when(whole, F.array(F.struct(run.alias("s"), F.lit(True).alias("value")))).otherwise(F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, cut_up))


def _phone(m: Column, key: Column) -> Column:
    """Another number of the same country code; area and exchange keep a first digit of 2 to 9 if they had one."""

    def renamed(digits: Column) -> Column:
        code = F.substring(digits, F.lit(1), F.length(digits) - 10)
        own = F.right(digits, F.lit(10))
        dialled = own.rlike("^[2-9][0-9]{2}[2-9]")
        value = (_number(own, F.lit(1), F.lit(3)) - 200) * 8_000_000 + _number(own, F.lit(4), F.lit(7)) - 2_000_000
        new = _permuted(value, F.lit(800).cast("long"), F.lit(8_000_000).cast("long"), key, "phone")
        new = _let(new, lambda x: F.concat((F.floor(x / 8_000_000) + 200).cast("string"), (x % 8_000_000 + 2_000_000).cast("string")))
        return _refilled(m, F.concat(code, F.when(dialled, new).otherwise(_digits_permuted(own, key, "line"))))

    return _let(F.regexp_replace(m, "[^0-9]", ""), renamed)


def _ssn(m: Column, key: Column) -> Column:
    """Another number of the areas, groups and serials that are given out."""
    area, group, serial = _number(m, F.lit(1), F.lit(3)), _number(m, F.lit(5), F.lit(2)), _number(m, F.lit(8), F.lit(4))
    rest = 99 * 9999
    value = (area - F.when(area < 666, 1).otherwise(2)) * rest + (group - 1) * 9999 + serial - 1

    def put(new: Column) -> Column:
        a, r = F.floor(new / rest), new % rest
        a = a + F.when(a < 665, 1).otherwise(2)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((F.floor(r / 9999) + 1).cast("string"), 2, "0"), F.lpad((r % 9999 + 1).cast("string"), 4, "0"))

    return _let(_permuted(value, F.lit(898).cast("long"), F.lit(rest).cast("long"), key, "ssn"), put)


def _ip(m: Column, key: Column) -> Column:
    value = F.aggregate(F.split(m, "[.]"), F.lit(0).cast("long"), lambda v, part: v * 256 + F.coalesce(part.try_cast("long"), F.lit(0).cast("long")))
    new = _permuted(value, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    return _let(new, lambda x: F.concat_ws(".", *[(F.shiftright(x, 8 * k) % 256).cast("string") for k in (3, 2, 1, 0)]))


def _date(m: Column, key: Column) -> Column:
    """Another day of 1900 to 2099; what is no day of the calendar stays."""
    first = F.lit("1900-01-01").cast("date")
    a, b = (F.lit(x).cast("long") for x in DAYS)
    last = DAYS[0] * DAYS[1] - 1

    def renamed(day: Column) -> Column:
        once = _permuted(F.date_diff(day, first).cast("long"), a, b, key, "date")
        within = _let(once, lambda x: F.when(x == last, _permuted(F.lit(last).cast("long"), a, b, key, "date")).otherwise(x))
        return F.when(day.isNull(), m).otherwise(F.date_add(first, within.cast("int")).cast("string"))

    return _let(F.try_to_timestamp(m, F.lit("yyyy-MM-dd")).cast("date"), renamed)


def _email(m: Column, key: Column) -> Column:
    return F.concat(_name_permuted(F.substring_index(m, "@", 1), key), F.lit("@"), F.substring_index(m, "@", -1))


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with the private values of the text replaced, and `private`: how many places of each kind changed.

    Kinds are e-mail addresses, IPv4 addresses, dates, social security numbers, card numbers and phone numbers.
    A value is judged by its kind's form and, for cards and dates, by its check digit or calendar; what
    fails stays as it is. The same key gives the same pseudonym everywhere, whatever separators a number
    is written with; whoever has the key can undo it. Null texts stay null with no places, empty and
    very long texts are no special case, repeated rows change alike. A column named `private` is replaced.
    """
    docs = docs.drop("private")
    secret = F.lit(key)
    # addresses of mail aside, every kind begins with one of few characters
    starting = "|".join(RUN if k == "card" else p for k, p in KINDS.items() if k != "email")
    pattern = f"{KINDS['email']}|(?=[0-9+(])(?:{starting})"
    # no kind is without a digit or an @, so most texts need no search
    found = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))

    def renamed(m: Column) -> Column:
        new = m
        for kind, maker in reversed(_MAKERS.items()):
            new = F.when(m.rlike(f"^(?:{KINDS[kind]})$"), F.struct(F.lit(kind).alias("kind"), maker(m, secret).alias("to"))).otherwise(new if kind != "phone" else F.struct(F.lit("").alias("kind"), m.alias("to")))
        return new

    def parts(m: Column) -> Column:
        return F.when(m.rlike(r"^[0-9][0-9 \-]{11,}[0-9]$"), _parted(m)).otherwise(F.array(F.struct(m.alias("s"), F.lit(True).alias("value"))))

    marked = docs.withColumns({"_old": found})
    marked = marked.withColumn("_parts", F.transform("_old", parts))
    marked = marked.withColumn("_new", F.transform("_parts", lambda some: F.transform(some, lambda p: F.when(p["value"], renamed(p["s"])).otherwise(F.struct(F.lit("").alias("kind"), p["s"].alias("to"))))))
    gaps = F.split(F.col(text), pattern, -1)
    values = F.transform("_new", lambda some: F.array_join(F.transform(some, lambda x: x["to"]), ""))
    filled = F.array_join(F.zip_with(F.concat(F.array(F.lit("")), values), gaps, lambda m, g: F.concat(m, g)), "")
    changed = F.filter(F.zip_with(F.flatten("_new"), F.flatten("_parts"), lambda n, o: F.when(n["to"] != o["s"], n["kind"])), lambda k: k.isNotNull())
    counts = F.map_from_arrays(F.array(*[F.lit(k) for k in KINDS]), F.array(*[F.size(changed) - F.size(F.array_remove(changed, k)) for k in KINDS]))
    counts = F.map_filter(counts, lambda _, n: n > 0)
    some = F.coalesce(F.size("_old") > 0, F.lit(False))
    return marked.select(*[F.when(some, filled).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns], F.when(some, counts).otherwise(F.create_map().cast("map<string,int>")).alias("private"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under a key for demonstration; a production job brings its own."""
    docs = pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), "demonstration key")
    return docs.select("doc_id", "text", *[F.coalesce(F.try_element_at("private", F.lit(k)), F.lit(0)).alias(f"n_{k}") for k in KINDS])


QUERIES = {"op3_pseudonyms": op3_pseudonyms}
