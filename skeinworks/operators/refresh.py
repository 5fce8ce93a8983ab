"""Page intake, one metadata shape over sources, change detection and refresh planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import collapse_space, overlap_similarity


def normalised_url(url) -> Column:
    """Scheme and host in lower case, without fragment, default port or closing slash."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    head = F.lower(F.regexp_extract(u, r"^([A-Za-z]+://[^/?]*)", 1))
    tail = F.regexp_replace(u, r"^[A-Za-z]+://[^/?]*", "")
    return F.concat(F.regexp_replace(head, r":(80|443)$", ""), F.regexp_replace(tail, r"/$", ""))


def page_facts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Normalised address, title, visible text and number of links of each page."""
    h = F.col(html)
    visible = F.regexp_replace(h, r"(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->", " ")
    text = collapse_space(F.regexp_replace(visible, r"<[^>]*>", " "))
    return pages.select(
        *[c for c in pages.columns if c not in (url, html)],
        normalised_url(F.col(url)).alias("url"),
        collapse_space(F.regexp_extract(h, r"(?is)<title>(.*?)</title>", 1)).alias("title"),
        text.alias("content"),
        F.regexp_count(h, F.lit(r"(?i)<a [^>]*href=")).alias("links"),
    )


def distinct_pages(facts: DataFrame, order: str) -> DataFrame:
    """The first page per normalised address."""
    rest = [c for c in facts.columns if c != "url"]
    one = facts.groupBy("url").agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return one.select("url", *[F.col(f"_r.{c}").alias(c) for c in rest])


def unified(sources: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One table (source, record_id, title, text, length, checksum) over differently shaped sources."""
    out = None
    for name, (df, fields) in sources.items():
        one = df.select(
            F.lit(name).alias("source"),
            fields["record_id"].cast("string").alias("record_id"),
            fields.get("title", F.lit(None)).cast("string").alias("title"),
            fields["text"].alias("text"),
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn("length", F.length("text")).withColumn("checksum", F.sha2("text", 256))


def source_registry(records: DataFrame) -> DataFrame:
    """Records, distinct texts, mean length and empty records per source."""
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("checksum").alias("distinct_texts"),
        F.avg("length").alias("mean_length"),
        F.count_if(F.col("length") == 0).alias("empty"),
    )


def changes(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """added / changed / removed / unchanged per key by checksum, with the weight of a change.

    The weight is 1 minus the word overlap of the two versions, 1 for added and removed rows.
    """
    a = old.select(key, F.col(text).alias("_old"), F.sha2(text, 256).alias("old_checksum"))
    b = new.select(key, F.col(text).alias("_new"), F.sha2(text, 256).alias("new_checksum"))
    d = a.join(b, key, "full")
    kind = (
        F.when(F.col("old_checksum").isNull(), "added")
        .when(F.col("new_checksum").isNull(), "removed")
        .when(F.col("old_checksum") == F.col("new_checksum"), "unchanged")
        .otherwise("changed")
    )
    d = d.withColumn("change", kind)
    weight = (
        F.when(F.col("change") == "unchanged", 0.0)
        .when(F.col("change") == "changed", 1 - overlap_similarity("_new", "_old"))
        .otherwise(1.0)
    )
    return d.withColumn("significance", weight).drop("_old", "_new")


def work_list(changed: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Only the rows of the new version that have to be processed again."""
    todo = changed.where(F.col("change").isin("added", "changed")).select(key)
    return new.join(todo, key, "left_semi")


def attempt_status(done: DataFrame, failed: Column, previous: DataFrame, key: str, at: Column) -> DataFrame:
    """Status per processed row with the number of retries so far."""
    d = done.select(key, failed.alias("_failed")).join(previous.select(key, "retries"), key, "left")
    return d.select(
        key,
        F.when(F.col("_failed"), "failed").otherwise("completed").alias("status"),
        (F.coalesce("retries", F.lit(0)) + F.col("_failed").cast("int")).alias("retries"),
        at.alias("updated_at"),
    )


def freshness(df: DataFrame, source: str, ts: str, ok: Column, *, as_of: Column, limit_minutes: int) -> DataFrame:
    """Age of the newest record, success and error rate per source, and a stale alert."""
    d = df.groupBy(source).agg(
        F.max(ts).alias("last_seen"), F.avg(ok.cast("double")).alias("success_rate"), F.count(F.lit(1)).alias("records")
    )
    age = F.timestamp_diff("MICROSECOND", F.col("last_seen"), as_of) / 60_000_000
    return d.withColumn("age_minutes", age).select(
        "*", (1 - F.col("success_rate")).alias("error_rate"), (F.col("age_minutes") > limit_minutes).alias("stale")
    )


def due_for_refresh(sources: DataFrame, *, last: str, priority: str, as_of: Column, minutes: dict[str, int]) -> DataFrame:
    """Sources whose interval (by priority) has passed since their last refresh, most urgent first."""
    wait = F.lit(None).cast("int")
    for name, m in minutes.items():
        wait = F.when(F.col(priority) == name, m).otherwise(wait)
    d = sources.withColumn("interval_minutes", wait)
    due_at = F.col(last) + F.make_interval(mins=F.col("interval_minutes"))
    return d.withColumn("due_at", due_at).where(F.col("due_at") <= as_of)
