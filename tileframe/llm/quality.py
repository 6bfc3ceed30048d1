"""Quality rules with host evidence, in DataFrame functions only.

Each document is judged alone by a base rule (too short, or more than half of it repeated) and by
stricter rules on symbols, repeated lines and word lengths. The rule failures are then aggregated by host; a
host's failure rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts
themselves, so that a host with three documents is not condemned by two of them. On a condemned host a
document that fails any rule is rejected; one that passes them all is kept wherever it comes from.

Defined results: a null or empty text has no words and so fails the base rule; a null host is no host and
brings no verdict; repeated rows are judged one by one; of the input only the named columns are read, so
other columns, whatever their names, do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import SPACE_CHARS, join_groups, settled, stored, text_or_empty, words_of

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: A host whose shrunk failure rate is above this is condemned.
HOST_LIMIT = 0.5
#: The prior counts as at least one and at most so many documents.
MAX_STRENGTH = 10_000.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the counts and ``_n_lines``.

    A window is three words. Its 32-bit hash and its place are packed into one long, so that one sort of
    longs brings equal hashes together; only the places that share a hash compare the windows themselves."""
    base = docs.withColumn("_text", text_or_empty(text)).withColumn("_words", words_of(F.col("_text")))
    base = base.withColumn("n_words", F.size("_words").cast("long"))
    packed = F.expr(
        "if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 3), i ->"
        " shiftleft(cast(hash(_words[i], _words[i + 1], _words[i + 2]) as bigint), 31) + i))"
    )
    base = base.withColumn("_packed", F.sort_array(packed))
    suspect = F.expr(
        "transform(filter(_packed, (x, j) -> shiftright(x, 31) = shiftright(get(_packed, j + 1), 31) or"
        " shiftright(x, 31) = shiftright(get(_packed, j - 1), 31)), x -> cast(x & 2147483647 as int))"
    )
    base = base.withColumn("_suspect", suspect)
    windows = F.expr(
        "sort_array(transform(_suspect, i ->"
        " struct(concat_ws(' ', _words[i], _words[i + 1], _words[i + 2]) as t, i as i)))"
    )
    base = base.withColumn("_windows", windows)
    starts = F.expr(
        "sort_array(transform(filter(_windows, (x, j) -> x.t = get(_windows, j + 1).t or"
        " x.t = get(_windows, j - 1).t), x -> x.i))"
    )
    base = base.withColumn("_starts", starts)
    covered = F.expr(
        "aggregate(_starts, struct(-3 as last, 0L as n),"
        " (a, p) -> struct(p as last, a.n + least(3, p - a.last) as n), a -> a.n)"
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    base = base.withColumn("_lines", lines)
    return base.select(
        *docs.columns,
        "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def any_failed() -> Column:
    """The base rule or a stricter one."""
    return (
        base_failed()
        | (2 * F.col("n_symbols") > F.col("n_words"))
        | (10 * F.col("n_dup_lines") > 3 * F.col("_n_lines"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 15 * F.col("n_words"))
    )


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """One row per host: ``_host``, its documents, failures, and the shrunk failure rate ``rate``.

    ``judged`` has ``_failed``. The prior's mean is the failure rate of all documents, its strength follows
    from the spread of the hosts' own rates (method of moments). Both are two numbers, fetched once."""
    hosts = stored(
        judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("_host")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("_failed").cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    whole = hosts.agg((F.sum("n_failed") / F.sum("n_docs")).alias("mean"), F.count(F.lit(1)).alias("n")).first()
    if not whole["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = whole["mean"]
    spread = hosts.agg(F.avg(F.pow(F.col("n_failed") / F.col("n_docs") - F.lit(mean), 2)).alias("v")).first()["v"]
    strength = MAX_STRENGTH if spread <= 0 else min(max(mean * (1 - mean) / spread - 1, 1.0), MAX_STRENGTH)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate)


def _verdict(judged: DataFrame, hosts: DataFrame) -> DataFrame:
    condemned = hosts.where(F.col("rate") > HOST_LIMIT).select("_host", F.lit(True).alias("_condemned"))
    joined = join_groups(judged, condemned, "_host")
    bad = F.coalesce(F.col("_condemned"), F.lit(False)) & F.col("_failed")
    return joined.withColumn("kept", ~(F.col("base_failed") | bad)).drop("_condemned", "_host", "_failed", "_n_lines")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row of ``docs``: the key, the counts, ``base_failed`` and ``kept``. Texts are read once."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_raw"), F.col(host).alias("_host"))
    judged = with_counts(rows, "_raw").drop("_raw")
    judged = stored(judged.select("*", base_failed().alias("base_failed"), any_failed().alias("_failed")), "quality")
    return _verdict(judged, host_rates(judged, "_host")).withColumnRenamed("_key", key).select(
        key, *COUNTS, "base_failed", "kept"
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are read twice and never shuffled or
    written: first for the hosts' rates, then with the condemned hosts joined to each document."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(whole, F.col(f"`{text}`").alias("_raw"), F.col(f"`{host}`").alias("_host"))
    judged = with_counts(rows, "_raw").select(
        "_row", "_host", "_n_lines", base_failed().alias("base_failed"), any_failed().alias("_failed")
    )
    judged = settled(judged, "base_failed", "_failed")
    hosts = host_rates(judged.select("_host", "_failed"), "_host")
    return _verdict(judged, hosts).where("kept").select("_row.*")
