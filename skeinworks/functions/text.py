"""Text expressions. Everything here is a Column built from built-in functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import fixed_values as fv


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Whitespace-separated words; an empty text has none."""
    return F.filter(F.split(_c(c), fv.SPACE + "+"), lambda w: w != "")


def tokens(c) -> Column:
    """Lower-cased runs of letters, digits and underscore."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(f"({fv.WORD}+)"), 1)


def strip(c) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(_c(c), f"^{fv.SPACE}+|{fv.SPACE}+$", "")


def single_spaced(c) -> Column:
    """Every run of white space as one blank. Blanks that stand alone are not even matched."""
    return F.regexp_replace(_c(c), fv.SPACE + "{2,}|(?! )" + fv.SPACE, " ")


def collapse_space(c) -> Column:
    return F.trim(single_spaced(c))


def redact_pii(c) -> Column:
    """Mask social-security and phone numbers, then collapse white space."""
    x = F.regexp_replace(_c(c), fv.SSN, re.sub(r"([\[\]])", r"\\\1", fv.SSN_MARK))
    x = F.regexp_replace(x, fv.PHONE, re.sub(r"([\[\]])", r"\\\1", fv.PHONE_MARK))
    return collapse_space(x)


def clean_text(c) -> Column:
    """Collapse white space and keep only word characters, spaces and .,!?;:-'\""""
    return F.trim(F.regexp_replace(single_spaced(c), r"""[^\p{L}\p{N}_ .,!?;:\-'"]""", ""))


def word_count(c) -> Column:
    """Blanks between words plus one."""
    x = collapse_space(c)
    return F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1)


def token_estimate(c) -> Column:
    """Word count over 0.75, cut to an integer."""
    return F.floor(word_count(c) / F.lit(0.75)).cast("long")


def avg_word_length(c) -> Column:
    letters = F.length(F.replace(collapse_space(c), F.lit(" "), F.lit("")))
    return letters / F.greatest(word_count(c), F.lit(1))


def has_number(c) -> Column:
    return _c(c).rlike(r"\p{Nd}")


def has_url(c) -> Column:
    low = F.lower(_c(c))
    return low.contains("http") | low.contains("www.")


def reading_level(avg_len) -> Column:
    a = _c(avg_len)
    return F.when(a < 4, "basic").when(a < 6, "intermediate").otherwise("advanced")


def keyword_hits(low: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur in the (lower-cased) text."""
    total = F.lit(0)
    for k in keywords:
        total = total + low.contains(k).cast("int")
    return total


def document_metrics(df, text: str = "text"):
    """Characters, words, estimated tokens, mean word length, digits, links and reading level.

    The white space is collapsed once, in a column of its own, and all counts are read off that.
    """
    d = df.withColumn("_flat", collapse_space(text)).withColumn("_letters", F.length(F.replace("_flat", F.lit(" "), F.lit(""))))
    d = d.withColumn("word_count", F.when(F.col("_flat") == "", 0).otherwise(F.length("_flat") - F.col("_letters") + 1))
    d = d.withColumn("avg_word_length", F.col("_letters") / F.greatest("word_count", F.lit(1)))
    return d.select(
        *df.columns,
        F.length(text).alias("character_count"),
        "word_count",
        F.floor(F.col("word_count") / F.lit(0.75)).cast("long").alias("estimated_tokens"),
        "avg_word_length",
        has_number(text).alias("has_numbers"),
        has_url(text).alias("has_urls"),
        reading_level("avg_word_length").alias("reading_level"),
    )


def topic_labels(c, top_n: int = 3) -> Column:
    """The topics with most keyword hits, ties in list order, at most `top_n`."""

    def labels(low: Column) -> Column:
        scored = F.array(
            *[
                F.struct(keyword_hits(low, kws).alias("hits"), F.lit(-i).alias("pos"), F.lit(t).alias("topic"))
                for i, (t, kws) in enumerate(fv.TOPIC_KEYWORDS.items())
            ]
        )
        ranked = F.sort_array(F.filter(scored, lambda s: s["hits"] > 0), asc=False)
        return F.transform(F.slice(ranked, 1, top_n), lambda s: s["topic"])

    # as a bound value, the text is lower-cased once and not for every keyword
    return F.transform(F.array(F.lower(_c(c))), labels).getItem(0)


def intent(c) -> Column:
    """Struct(intent, confidence): most keyword hits, first on ties; none gives the default."""
    low = F.lower(_c(c))
    scored = F.array(
        *[
            F.struct(
                keyword_hits(low, kws).alias("hits"),
                F.lit(-i).alias("pos"),
                F.lit(name).alias("intent"),
                F.lit(len(kws)).alias("of"),
            )
            for i, (name, kws) in enumerate(fv.INTENT_KEYWORDS.items())
        ]
    )
    best = F.array_max(scored)
    return F.when(
        best["hits"] > 0,
        F.struct(
            best["intent"].alias("intent"),
            F.least(F.lit(1.0), best["hits"] / best["of"]).alias("confidence"),
        ),
    ).otherwise(
        F.struct(F.lit(fv.DEFAULT_INTENT[0]).alias("intent"), F.lit(fv.DEFAULT_INTENT[1]).alias("confidence"))
    )


def path_facts(path) -> Column:
    """Struct(category, file_type, doc_id) read off an object path."""
    p = _c(path)
    category = F.lit("general")
    for seg, name in reversed(fv.PATH_CATEGORIES.items()):
        category = F.when(p.contains(seg), name).otherwise(category)
    ext = F.when(p.contains("."), F.lower(F.element_at(F.split(p, r"\."), -1))).otherwise("unknown")
    return F.struct(
        category.alias("category"), ext.alias("file_type"), F.translate(p, "/.", "__").alias("doc_id")
    )


def quality_checks(c) -> Column:
    """Struct of the five review checks and the share passed."""
    x = _c(c)
    checks = {
        "min_length": F.length(x) >= 10,
        "has_product_reference": x.rlike(f"(?i){fv.PRODUCT_PATTERN}"),
        "has_opinion": x.rlike(f"(?i){fv.OPINION_PATTERN}"),
        "no_profanity": ~x.rlike(f"(?i){fv.PROFANITY_PATTERN}"),
        "has_structure": x.contains("."),
    }
    passed = sum((v.cast("int") for v in checks.values()), F.lit(0))
    return F.struct(*[v.alias(k) for k, v in checks.items()], (passed / F.lit(5)).alias("quality_score"))


def rating_value(c) -> Column:
    """Rating words as 1..5; other values are kept when they are numbers."""
    pairs = [F.lit(x) for kv in fv.RATING_VALUES.items() for x in kv]
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), _c(c)).cast("double"), _c(c).try_cast("double")
    )


def survey_sentence(
    customer, satisfaction, product=None, service=None, area=None, comments=None
) -> Column:
    """One sentence per survey row; absent or null parts are left out."""
    s = _c(satisfaction)
    level = F.when(s >= 4, "satisfied").when(s == 3, "neutral").otherwise("dissatisfied")
    parts = [
        F.concat(
            F.lit("Customer "), _c(customer).cast("string"), F.lit(" was "), level,
            F.lit(" overall with their experience. "),
        )
    ]
    if product is not None:
        parts.append(F.concat(F.lit("They rated the product "), _c(product).cast("string"), F.lit("/5. ")))
    if service is not None:
        parts.append(
            F.concat(F.lit("They rated the customer service "), _c(service).cast("string"), F.lit("/5. "))
        )
    if area is not None:
        parts.append(F.concat(F.lit("They suggested improvements in the area of "), _c(area), F.lit(". ")))
    if comments is not None:
        said = F.concat(F.lit("Their comments: '"), _c(comments), F.lit("'"))
        parts.append(F.when(F.length(_c(comments)) > 0, said))
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def overlap_similarity(output, truth, *, jaccard_weight: float = 0.4, recall_weight: float = 0.6) -> Column:
    """Weighted Jaccard and recall of the two lower-cased word sets (unrounded)."""
    a = F.array_distinct(words(F.lower(_c(output))))
    b = F.array_distinct(words(F.lower(_c(truth))))
    common = F.size(F.array_intersect(a, b))
    jac = common / F.size(F.array_union(a, b))
    score = F.lit(jaccard_weight) * jac + F.lit(recall_weight) * common / F.size(b)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), score).otherwise(F.lit(0.0))


def item_text(title, description) -> Column:
    return F.concat_ws(". ", _c(title), _c(description))


def training_text(question, answer) -> Column:
    return F.concat(F.lit("Question: "), _c(question), F.lit("\nAnswer: "), _c(answer))


def post_text(title, body) -> Column:
    has_body = F.coalesce(F.length(_c(body)), F.lit(0)) > 0
    return F.when(has_body, F.concat(_c(title), F.lit("\n\n"), _c(body))).otherwise(_c(title))


def margin(price, cost) -> Column:
    return _c(price) - _c(cost)


def margin_ratio(price, cost) -> Column:
    return F.try_divide(_c(price) - _c(cost), _c(price))


def form_fields(c) -> Column:
    """Struct of the labelled fields in a claim form."""
    x = _c(c)

    def after(label):
        return F.regexp_extract(x, label + r":[ \t]*([^\n]*)", 1)

    amount = F.regexp_extract(x, r"Claim Amount\):[ \t]*\$?([\d,]+(?:\.\d+)?)", 1)
    about = F.regexp_extract(x, r"(?s)DESCRIPTION OF INCIDENT\n-+\n(.*?)\n-{5,}", 1)
    return F.struct(
        strip(after("Full Name")).alias("claimant_name"),
        F.regexp_extract(x, r"(POL-\d+)", 1).alias("policy_number"),
        F.to_date(F.regexp_extract(x, r"Date of Incident:[ \t]*(\d{4}-\d{2}-\d{2})", 1).try_cast("date")).alias(
            "incident_date"
        ),
        F.regexp_replace(amount, ",", "").try_cast("double").alias("claim_amount"),
        strip(about).alias("description"),
    )


def parsed_json(c, schema: str) -> Column:
    """Struct(value, raw, ok): the typed value, or the raw text when it does not parse."""
    full = F.from_json(_c(c), f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    ok = full.isNotNull() & full["_corrupt"].isNull()
    return F.struct(full.alias("value"), F.when(~ok, _c(c)).alias("raw"), ok.alias("ok"))


def truncate(c, n: int, mark: str = "") -> Column:
    x = _c(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit(mark))).otherwise(x)


def performance_band(metric, value) -> Column:
    m, v = _c(metric), _c(value)
    out = F.lit("Poor")
    for name, bands in fv.BANDS.items():
        band = F.lit("Poor")
        for label, low in reversed(bands):
            band = F.when(v >= low, label).otherwise(band)
        out = F.when(m == name, band).otherwise(out)
    return out


def embedding_verdict(metric, value) -> Column:
    m, v = _c(metric), _c(value)
    out = F.lit(None).cast("string")
    for name, (op, limit, weak) in fv.EMBEDDING_LIMITS.items():
        good = v > limit if op == ">" else v < limit
        out = F.when(m == name, F.when(good, "Good").otherwise(weak)).otherwise(out)
    return out


def entities(c, kind: str) -> Column:
    """All matches of one entity kind, first seen first, without repeats."""
    return F.array_distinct(F.regexp_extract_all(_c(c), F.lit(f"(?iu){fv.ENTITY_PATTERNS[kind]}"), 0))


def term_counts(df, text_tokens: str, out: str = "term_counts"):
    """Add array<struct<term, tf>> for a token-array column, without leaving the row.

    The tokens are sorted and the run lengths read off, so the work is n log n in the
    length of one text and needs no shuffle.
    """
    d = df.withColumn("_sorted", F.sort_array(text_tokens))
    d = d.withColumn(
        "_starts",
        F.when(F.size("_sorted") == 0, F.array().cast("array<int>")).otherwise(
            F.filter(
                F.sequence(F.lit(1), F.greatest(F.size("_sorted"), F.lit(1))),
                lambda i: (i == 1) | (F.get("_sorted", i - 1) != F.get("_sorted", i - 2)),
            )
        ),
    )
    runs = F.transform(
        "_starts",
        lambda s, j: F.struct(
            F.get("_sorted", s - 1).alias("term"),
            (F.coalesce(F.get("_starts", j + 1), F.size("_sorted") + 1) - s).alias("tf"),
        ),
    )
    return d.withColumn(out, runs).drop("_sorted", "_starts")
