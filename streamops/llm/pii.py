"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates: one regular expression per kind over the whole text, with the
   words around each match.  Positions come from the lengths of the pieces
   between the matches, summed in a window over one document's matches.
2. Labelers vote +1, 0 or -1 on every candidate: strict form and checksums,
   gazetteers, cue words before it, the characters it touches, and digit shape.
3. Expectation-maximisation estimates how reliable each labeler is.  It needs
   only the number of candidates per (kind, vote pattern): at most 9 * 3^5 rows
   whatever the corpus, counted in Spark over all candidates.
4. The posteriors train the final span classifier, a naive Bayes over votes and
   surface features, from sums per feature value taken over all candidates.
   Base spans always stay; the classifier adds the others it is sure of.

Patterns start a run only at its left edge (or where the last match ended) and
quantify possessively, which gives the same leftmost matches as the plain forms
and keeps the search linear and free of recursion on very long texts.

Defined results: a null text has no spans; repeated rows get equal spans; an
empty table gives no rows; other columns are ignored (kept by ``redact``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamops.llm.common import settle, sieve, with_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "mail", "tel", "ssn", "iban", "name")

# Patterns of the contract (the first four) in their linear forms, and of the
# method's further kinds.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[a-z0-9-]{1,63}+"
            r"(?: ?(?:\(dot\)|\[dot\]|\.) ?[a-z0-9-]{2,63}+){1,4}",
    "tel": r"(?<![0-9+(.-])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}(?![0-9.])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora)\.?\x20"
            r"\p{Lu}\p{L}{1,30}(?:\x20\p{Lu}\p{L}{1,30})?",
}
#: What a text must hold for a pattern to be tried at all.
GATE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "mail": lambda t: t.rlike(r"(?i)[(\[]at[)\]]"),
    "tel": lambda t: t.rlike(r"[0-9][0-9]\)?[\x20./-][0-9][0-9]"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9][0-9]-[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z][A-Z][0-9][0-9]\x20?[A-Z0-9]"),
    "name": lambda t: t.rlike(r"(?:M[rs]|Mrs|Mme|Dr|Prof|Herr|Frau|onsieur|adame|eñora?)\.?\x20\p{Lu}"),
}
# Gazetteers: fixed values.
TLDS = ("com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "co", "de", "fr", "es", "it", "uk", "eu", "ch",
        "at", "be", "nl", "pl", "pt", "se", "no", "dk", "fi", "ie", "us", "ca", "mx", "br", "ar", "au", "nz", "jp",
        "cn", "in", "ru", "kr", "za")
DIAL_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
              "49", "51", "52", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82",
              "84", "86", "90", "91", "92", "93", "94", "95", "98", "212", "213", "216", "234", "254", "351", "352",
              "353", "354", "358", "359", "370", "371", "372", "380", "420", "421", "852", "886", "966", "971", "972")
IBAN_COUNTRIES = ("AD", "AE", "AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR",
                  "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MC", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI",
                  "SK", "TR")
FIRST_NAMES = ("anna", "anne", "carlos", "carmen", "charles", "claire", "david", "elena", "elizabeth", "emma", "hans",
               "james", "jean", "jennifer", "john", "jorge", "jose", "juan", "julia", "karl", "laura", "linda", "luis",
               "maria", "marie", "mark", "mary", "michael", "patricia", "paul", "peter", "pierre", "robert", "sarah",
               "sofia", "susan", "thomas", "william")
CUES = {
    "email": "e-?mail|mail|contact|correo|write", "mail": "e-?mail|mail|contact|correo|write",
    "ip": "ip|address|host|server|from|login", "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|téléphone|teléfono|contact",
    "tel": "phone|tel|call|mobile|cell|fax|telefon|téléphone|teléfono",
    "ssn": "ssn|social security|social", "iban": "iban|account|konto|compte|cuenta", "name": "name|dear|by|contact",
}
ANTI_CUES = r"(?i)(?:version|ver|v|release|figure|fig|table|page|isbn|issn|order|section|chapter|part|serial|doi)[.:#\s]*$"

LABELERS = ("v_form", "v_gazetteer", "v_cue", "v_edge", "v_shape")
FEATURES = (*LABELERS, "f_kind", "f_length", "f_digits", "f_before", "f_after")
ROUNDS = 25
ADD_ABOVE = 0.95


# ------------------------------------------------------------- candidates


def row_key() -> list[Column]:
    """Names a row by content, so that repeated rows share one result."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_row")]


def found(kind: str, text: Column) -> Column:
    """array<struct<kind, i, gap, hit, before, after>> of one kind's matches."""
    pattern = F.lit(PATTERN[kind])
    hits, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, PATTERN[kind], -1)
    each = F.transform(F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), F.slice(gaps, 2, F.size(gaps)).alias("next")),
                       lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).cast("long").alias("gap"), x["hit"].alias("hit"),
        F.right(x["gap"], F.lit(40)).alias("before"), F.left(x["next"], F.lit(8)).alias("after")))
    return F.when(GATE[kind](text), F.filter(each, lambda x: x["hit"].isNotNull()))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per match of any kind, with its start and end in code points."""
    shape = "array<struct<kind:string,i:int,gap:bigint,hit:string,before:string,after:string>>"
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "text").select(*row_key(), t.alias("_t"))
    lists = [F.coalesce(found(k, F.col("_t")), F.array().cast(shape)).cast(shape) for k in KINDS]
    c = d.select("_id", "_row", F.concat(*lists).alias("_c")).where(F.size("_c") > 0)
    return c.dropDuplicates(["_id", "_row"]).select("_id", "_row", F.explode("_c").alias("c")).select("_id", "_row", "c.*")


def positioned(c: DataFrame) -> DataFrame:
    w = Window.partitionBy("_id", "_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("hit")).over(w)
    return c.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))


# ---------------------------------------------------------------- labelers


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def term(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(hit: Column) -> Column:
    s = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.left(s, F.lit(4)))

    def step(a, i):
        ch = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(ch < 65, (a * 10 + ch - 48) % 97).otherwise((a * 100 + ch - 55) % 97).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def base_check() -> Column:
    hit, kind = F.col("hit"), F.col("kind")
    digits = digits_of(hit)
    parts = F.forall(F.split(hit, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(256)) <= 255)
    return (F.when(kind == "email", True).when(kind == "ip", parts)
            .when(kind == "card", F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(9, 15)).otherwise(False))


def with_votes(c: DataFrame) -> DataFrame:
    hit, kind, before, after = (F.col(x) for x in ("hit", "kind", "before", "after"))
    digits, low = digits_of(hit), F.lower(hit)

    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(no if no is not None else ~yes, -1).otherwise(0)

    ssn_ok = ~hit.rlike(r"^(?:000|666|9)|-00-|-0000$")
    form = (F.when(kind.isin(*BASE_KINDS), vote(F.col("base")))
            .when(kind == "ssn", vote(ssn_ok)).when(kind == "iban", vote(mod97(hit)))
            .when(kind == "tel", vote(F.length(digits).between(9, 11), F.length(digits) < 8))
            .otherwise(F.lit(0)))
    name_word = F.regexp_extract(low, r"^\S+ (\p{L}+)", 1)
    tld = F.regexp_extract(low, r"[.)\] ]([a-z0-9-]+)$", 1)
    dial = [digits.startswith(x) for x in DIAL_CODES]
    some = dial[0]
    for x in dial[1:]:
        some = some | x
    gazetteer = (F.when(kind.isin("email", "mail"), vote(tld.isin(*TLDS)))
                 .when(kind == "ip", vote(F.regexp_extract(hit, "^0*([0-9]{1,9})", 1).try_cast("int").between(1, 223)))
                 .when(kind == "card", vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")))
                 .when(kind == "phone", vote(some))
                 .when(kind == "iban", vote(F.left(hit, F.lit(2)).isin(*IBAN_COUNTRIES)))
                 .when(kind == "name", F.when(name_word.isin(*FIRST_NAMES), 1).otherwise(0))
                 .otherwise(F.lit(0)))
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = F.when(kind == k, before.rlike(rf"(?i)(?<!\p{{L}})(?:{words})\p{{L}}{{0,3}}[^\p{{L}}]{{0,12}}$")).otherwise(cue)
    edge = before.rlike(r"[\p{L}0-9_@#]$") | after.rlike(r"^[\p{L}0-9_@]")
    flat = digits.rlike(r"^([0-9])\1+$")
    return (c.withColumn("v_form", F.coalesce(form, F.lit(0))).withColumn("v_gazetteer", F.coalesce(gazetteer, F.lit(0)))
            .withColumn("v_cue", vote(cue, before.rlike(ANTI_CUES)))
            .withColumn("v_edge", F.when(edge, -1).otherwise(1))
            .withColumn("v_shape", F.when(flat, -1).when(F.length(digits) >= 9, 1).otherwise(0))
            .withColumn("f_kind", kind)
            .withColumn("f_length", F.least(F.length(hit) / 8, F.lit(6)).cast("int").cast("string"))
            .withColumn("f_digits", F.floor(F.length(digits) * 4 / F.length(hit)).cast("string"))
            .withColumn("f_before", char_class(F.right(before, F.lit(1))))
            .withColumn("f_after", char_class(F.left(after, F.lit(1)))))


def char_class(ch: Column) -> Column:
    return (F.when(ch == "", "none").when(ch.rlike(r"\s"), "space").when(ch.rlike(r"\p{L}"), "letter")
            .when(ch.rlike("[0-9]"), "digit").otherwise("sign"))


# ------------------------------------------- reliabilities and the classifier


def em(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """P(personal | votes) for each vote pattern, by expectation-maximisation
    over a two-class model with independent labelers; counts are smoothed, and
    the first guess is the majority vote."""
    post = {p: min(0.95, max(0.05, 0.5 + 0.2 * sum(p))) for p, _ in patterns}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        one = sum(n * post[p] for p, n in patterns)
        prior = (one + 1) / (total + 2)
        table = []
        for j in range(len(LABELERS)):
            cell = {(c, v): 1.0 + (1.0 if c * 2 - 1 == v else 0.0) for c in (0, 1) for v in (-1, 0, 1)}
            for p, n in patterns:
                cell[1, p[j]] += n * post[p]
                cell[0, p[j]] += n * (1 - post[p])
            sums = {c: sum(cell[c, v] for v in (-1, 0, 1)) for c in (0, 1)}
            table.append({k: x / sums[k[0]] for k, x in cell.items()})
        for p, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(table[j][1, v] / table[j][0, v]) for j, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return post


def scored(spark: SparkSession, votes: DataFrame) -> DataFrame:
    """Adds ``score``, the classifier's probability that a span is personal."""
    counted = votes.groupBy(*LABELERS).agg(F.count("*").alias("n")).collect()      # at most 3^5 rows
    patterns = sorted((tuple(r[v] for v in LABELERS), r["n"]) for r in counted)
    if not patterns:
        return votes.withColumn("score", F.lit(0.0))
    post = em(patterns)
    rows = ", ".join(f"({', '.join(map(str, p))}, {post[p]:.12f}D)" for p, _ in patterns)
    known = spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(LABELERS)}, post)")
    soft = votes.join(F.broadcast(known), list(LABELERS))
    stack = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("x")) for f in FEATURES)))
    sums = soft.select("post", stack.alias("s")).groupBy("s.f", "s.x").agg(
        F.sum("post").alias("one"), F.count("*").alias("n")).collect()              # a row for each feature value
    per: dict[str, dict[str, tuple[float, float]]] = {}
    for r in sums:
        per.setdefault(r["f"], {})[r["x"]] = (r["one"], r["n"] - r["one"])
    ones, zeros = (sum(x[i] for x in per["f_kind"].values()) for i in (0, 1))
    total = F.lit(math.log((ones + 1) / (zeros + 1)))
    for f, values in per.items():
        pairs: list[Column] = []
        for x, (a, b) in sorted(values.items()):
            k = len(values)
            pairs += [F.lit(x), F.lit(math.log((a + 1) / (ones + k)) - math.log((b + 1) / (zeros + k)))]
        total = total + F.coalesce(F.create_map(*pairs)[F.col(f).cast("string")], F.lit(0.0))
    return votes.withColumn("score", 1 / (1 + F.exp(-total)))


def spans(spark: SparkSession, docs: DataFrame, add_above: float = ADD_ABOVE) -> DataFrame:
    """_id, _row, kind, rank of kind, start, end, base, score: the spans kept."""
    c = settle(spark, candidates(docs), "candidates")
    v = with_votes(positioned(c).withColumn("base", F.coalesce(base_check(), F.lit(False))))
    v = scored(spark, settle(spark, v, "votes"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    v = v.withColumn("rank", rank)
    here = Window.partitionBy("_id", "_row").orderBy("start", F.col("base").desc(), "rank")
    past = F.max(F.when(F.col("base"), F.col("end"))).over(here.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(here.rowsBetween(1, Window.unboundedFollowing))
    v = v.withColumn("_past", past).withColumn("_ahead", ahead)
    free = (F.coalesce("_past", F.lit(0)) <= F.col("start")) & (F.coalesce("_ahead", F.col("end")) >= F.col("end"))
    return v.where(F.col("base") | ((F.col("score") >= add_above) & free)).select(
        "_id", "_row", "kind", "rank", "start", "end", "base", "score")


def listed(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: counts, digest and list of its spans."""
    s = spans(spark, docs)
    item = F.struct("rank", "start", "end", "kind", "base")
    per = s.groupBy("_id", "_row").agg(
        F.sort_array(F.collect_list(item)).alias("_all"),
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE_KINDS))
    per = per.select("_id", "_row", *(f"n_{k}" for k in BASE_KINDS),
                     listed(F.filter("_all", lambda x: x["base"])).alias("_base"), listed(F.col("_all")).alias("spans"))
    keyed = docs.select("doc_id", "text").select("doc_id", *row_key())
    out = keyed.join(settle(spark, per, "spans"), ["_id", "_row"], "left")
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
                      F.sha2(F.encode(F.coalesce("_base", F.lit("")), "UTF-8"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))


def redact(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pipeline's form: every span is replaced by its kind in brackets
    (overlapping ones by the first's), and n_chars follows the text."""
    s = spans(spark, docs)
    here = Window.partitionBy("_id", "_row").orderBy("start", F.desc("end"), "rank")
    s = s.withColumn("_reach", F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1)))
    s = s.withColumn("_new", F.when(F.col("start") < F.col("_reach"), 0).otherwise(1))
    s = s.withColumn("_n", F.sum("_new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    merged = s.groupBy("_id", "_row", "_n").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                                F.min_by("kind", F.struct("start", -F.col("end"), "rank")).alias("kind"))
    per = merged.groupBy("_id", "_row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("_m"))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *row_key())
    # most documents hold no span: only those that may are moved
    masks = settle(spark, per, "masks")
    sure, some = sieve(spark, keyed, masks, ["_id", "_row"])
    some = some.join(masks.hint("merge"), ["_id", "_row"], "left")
    m, text = F.col("_m"), F.col("_doc").getField("text")

    def part(x, i):
        begin = F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0)).cast("int")
        return F.concat(F.substring(text, begin + 1, x["start"].cast("int") - begin), F.lit("["), F.upper(x["kind"]), F.lit("]"))
    last = F.get(m, F.size(m) - 1)["end"].cast("int")
    masked = F.concat(F.array_join(F.transform(m, part), ""), F.substring(text, last + 1, F.length(text)))
    return sure.select("_doc.*").unionByName(some.select(*with_text(docs, F.col("_doc"), masked, m.isNotNull())))
