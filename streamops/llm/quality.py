"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: word counts, symbols, repeated lines, and words inside repeated
five-word windows.  Across texts: every line is normalised (lower case, runs of
white space to one space, digits to 0) and hashed, the documents of its host
that hold it are counted, and lines above the host's limit are removed; a
document of which too little remains is rejected.

Copies are the business of the near-duplicate stage, not of this one: rows of
one and the same text count as one document, both of a line and of its host, so
the lines of a text with a thousand copies don't look like boilerplate.  Texts
that differ anywhere are different documents.

Plan: one scan turns texts into a small table of counts and line hashes (no
shuffle); the line counts are two partial aggregates, so a host or line with a
third of all rows is combined before it is shuffled; lines above the limit go
back to the documents by a join that is salted on the document.

Defined results: a null text has no words and fails the base rule; a null host
is a host of its own; repeated rows get equal verdicts; an empty table gives no
rows; columns other than doc_id, source and text are carried or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import settle, sieve, with_text

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"            # fixed by the contract
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: A line is boilerplate in a host when more than MIN_DOCS documents hold it; one
#: of fewer than LONG_LINE words also needs more than HOST_SHARE of the host's.
MIN_DOCS = 20
HOST_SHARE = 0.01
LONG_LINE = 10
#: A document is depleted when fewer words than MIN_WORDS_LEFT or less than
#: SHARE_LEFT of its word characters remain.
MIN_WORDS_LEFT = 5
SHARE_LEFT = 0.2
SALT = 16


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")), "[0-9]", "0")


def with_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, and the helper columns _same and _lines.

    A position is inside a repeated window if a window that starts at most four
    words before it occurs twice; with the starts p1 < p2 < ... of such windows
    the words covered are the sum of min(5, p[i+1] - p[i]), and 5 for the last.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_t", text).withColumn("_w", words_of(F.col("_t")))
    d = d.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))).withColumn("n_words", F.size("_w").cast("long"))
    h = F.col("_h")
    d = d.withColumn("_win", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("_dup", F.size("_win") > F.size(F.array_distinct("_win")))
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    d = d.withColumn("_s", F.when(F.col("_dup"), F.array_sort(F.transform(
        "_win", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).otherwise(none))
    s, n = F.col("_s"), F.size("_s")
    # out of range reads give null, and null = x is no match
    starts = F.filter("_s", lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                      | ((i > 0) & F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))))
    d = d.withColumn("_p", F.when(n > 0, F.sort_array(F.transform(starts, lambda x: x["p"])))
                     .otherwise(F.array().cast("array<int>")))
    p = F.col("_p")
    covered = F.aggregate(F.transform("_p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x,
                                                                                          F.lit(WINDOW)))),
                          F.lit(0), lambda a, b: a + b)
    d = d.withColumn("n_repeat_words", covered.cast("long"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = (d.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
         .withColumn("word_chars", word_chars(F.col("_t")).cast("long"))
         .withColumn("n_symbols", (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"))
         .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
         .withColumn("_same", F.xxhash64("_t"))
         .withColumn("_lines", F.transform("_l", lambda x: F.struct(
             F.xxhash64(normalised(x)).alias("line"), word_chars(x).alias("chars"),
             F.size(words_of(x)).alias("words")))))
    return d.drop("_w", "_h", "_win", "_dup", "_s", "_p", "_l")


def key_columns() -> list[Column]:
    """Names a row by its content, so that repeated rows share one verdict."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source"), F.lit("\x00")),
                       F.coalesce(F.col("doc_id"), F.lit(-1))).alias("_row")]


def frequent_lines(counted: DataFrame, min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE) -> DataFrame:
    """(_host, line): the lines above their host's limit."""
    # one row for each (host, text) and (host, line, text): two partial aggregates, no distinct sets
    texts = counted.groupBy("_host", "_same").agg(F.lit(1).alias("one"))
    hosts = texts.groupBy("_host").agg(F.count("one").alias("n_host"))
    each = counted.select("_host", "_same", F.explode("_lines").alias("l")).select("_host", "_same", "l.line", "l.words")
    docs = each.groupBy("_host", "line", "_same").agg(F.max("words").alias("words"))
    per = docs.groupBy("_host", "line").agg(F.count("*").alias("n"), F.max("words").alias("words")).where(F.col("n") > min_docs)
    return per.join(hosts, "_host").where((F.col("words") >= LONG_LINE) | (F.col("n") > host_share * F.col("n_host"))).select(
        "_host", "line")


def verdicts(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS,
             host_share: float = HOST_SHARE) -> DataFrame:
    """One row for each row of ``docs``: the counts, ``kept``, ``removed`` (the
    hashes of the lines taken out), and the row's key (_id, _row)."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    host = F.coalesce(F.col("source"), F.lit("\x00")).alias("_host")
    table = with_counts(docs.select("doc_id", "source", "text")).select(
        "doc_id", host, *key_columns(), *counts, "_same", "_lines")
    counted = settle(spark, table, "quality")
    salt = F.pmod(F.col("_row"), F.lit(SALT))
    often = frequent_lines(counted, min_docs, host_share).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    lines = counted.where(~F.col("base_failed")).dropDuplicates(["_id", "_row"]).select(
        "_id", "_row", "_host", salt.alias("_salt"), F.explode("_lines").alias("l")).select(
        "_id", "_row", "_host", "_salt", "l.*")
    gone = lines.join(often, ["_host", "line", "_salt"]).groupBy("_id", "_row").agg(
        F.sum("chars").alias("chars_gone"), F.sum("words").alias("words_gone"),
        F.collect_set("line").alias("removed"))
    left_words = F.col("n_words") - F.coalesce("words_gone", F.lit(0))
    left_chars = F.col("word_chars") - F.coalesce("chars_gone", F.lit(0))
    depleted = F.col("words_gone").isNotNull() & (
        (left_words < MIN_WORDS_LEFT) | (left_chars < SHARE_LEFT * F.col("word_chars")))
    return counted.join(gone, ["_id", "_row"], "left").select(
        "doc_id", *counts, (~F.col("base_failed") & ~depleted).alias("kept"), "_id", "_row", "removed")


def filter_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pipeline's form: rejected documents go, boilerplate lines are taken
    out of the others, and n_chars follows the text."""
    v = settle(spark, verdicts(spark, docs).select("_id", "_row", "kept", "removed").where(
        "not kept or removed is not null").dropDuplicates(["_id", "_row"]), "verdicts")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *key_columns())
    # most documents stay as they are: only those that may have a verdict are moved
    sure, some = sieve(spark, keyed, v, ["_id", "_row"])
    kept = some.join(v.hint("merge"), ["_id", "_row"], "left").where(F.coalesce("kept", F.lit(True)))
    cut = F.array_join(F.filter(F.split(F.col("_doc").getField("text"), "\n", -1), lambda x: ~(
        x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains("removed", F.xxhash64(normalised(x))))), "\n")
    return sure.select("_doc.*").unionByName(kept.select(*with_text(docs, F.col("_doc"), cut, F.col("removed").isNotNull())))
