"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured and held against rules. Failures are counted by host; each host's failure
rate is shrunk towards the corpus by a beta prior fitted to all hosts, so a host with few documents is
not judged on them alone. A host whose shrunken rate is high is suspect for that rule, and its
documents have to meet the rule's strict limit. Clean documents meet that too, wherever they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebeam.session import materialize

WHITE_SPACE = " \t\n\u000b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A rule: what is counted, in how many it is counted, and the share that is too much, usually and on
#: suspect hosts.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.10, 0.05),
    "shouting": ("n_capitals", "word_chars", 0.50, 0.30),
    "exclaiming": ("n_exclaims", "n_words", 0.10, 0.05),
    "dup_lines": ("n_dup_lines", "n_lines", 0.50, 0.40),
}
#: A host is suspect for a rule if its shrunken failure rate is over this and over twice the corpus's.
SUSPECT_RATE = 0.25
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
            "n_exclaims")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with value computed once, however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_positions(words: Column, n: Column) -> Column:
    """Sorted positions of the 3-word windows that occur twice or more. Windows are first sorted as
    numbers, 40 bits of hash and 24 of position; those that share the hash are sorted by their words."""
    low = (1 << 24) - 1
    spots = F.sequence(F.lit(0), n - 3)

    def hash_at(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def spelled(at: Column) -> Column:
        return F.sort_array(F.transform(at, lambda i: F.struct(
            F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"),
            i.alias("i"))))

    def twins(sorted_array: Column, key: Callable[[Column], Column]) -> Column:
        return F.filter(sorted_array, lambda x, j: (key(x) == key(F.get(sorted_array, j - 1)))
                        | (key(x) == key(F.get(sorted_array, j + 1))))

    few = let(F.sort_array(F.transform(spots, lambda i: hash_at(i).bitwiseAND(F.lit(~low)).bitwiseOR(
        i.cast("long")))), lambda s: F.transform(
        twins(s, lambda x: F.shiftright(x, 24)), lambda x: x.bitwiseAND(F.lit(low)).cast("int")))
    candidates = F.when(n <= low, few).otherwise(spots)
    return let(spelled(candidates), lambda s: F.sort_array(F.transform(
        twins(s, lambda x: F.struct(x["a"], x["b"], x["c"])), lambda x: x["i"])))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text, the first included."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.when(j == 0, 3).otherwise(
            F.least(F.lit(3), p - F.get(at, j - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    n = F.size(words)
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(_repeated_positions(words, n), covered))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` and the measures (long) of each whole text; a null text counts as empty."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))

    def removed(characters: str) -> Column:
        return F.char_length(F.translate(body, characters, ""))

    def lines_of(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    lines = let(F.filter(F.split(body, "\n"), lambda x: F.char_length(F.translate(x, WHITE_SPACE, "")) > 0), lines_of)
    words = let(F.filter(F.split(body, SPLIT), lambda x: x != ""),
                lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeat")))
    kept = [c for c in docs.columns if c not in MEASURES]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], words.alias("__words"), lines.alias("__lines"),
                       F.char_length(body).cast("long").alias("__chars"), removed(WHITE_SPACE).cast("long").alias("word_chars"),
                       removed(SYMBOLS).cast("long").alias("__symbols"), removed(CAPITALS).cast("long").alias("__capitals"),
                       removed("!").cast("long").alias("__exclaims"))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__words.n").alias("n_words"), "word_chars",
        (F.col("__chars") - F.col("__symbols")).alias("n_symbols"), F.col("__lines.dup").alias("n_dup_lines"),
        F.col("__words.repeat").alias("n_repeat_words"), F.col("__lines.n").alias("n_lines"),
        (F.col("__chars") - F.col("__capitals")).alias("n_capitals"),
        (F.col("__chars") - F.col("__exclaims")).alias("n_exclaims"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def over(rule: str, strict: bool = False) -> Column:
    count, of, usual, tight = RULES[rule]
    return F.col(count) > F.lit(tight if strict else usual) * F.col(of)


def host_verdicts(rows: DataFrame) -> DataFrame:
    """(host, n_docs, and for each rule the shrunken rate and whether the host is suspect) from measured
    rows with a column host. A host is suspect for a rule if its rate is over `SUSPECT_RATE` and over twice the
    rate of all other hosts. The prior's mean is the corpus's failure rate; its strength follows from
    how far the hosts' rates spread beyond what their sizes explain (method of moments). One row of
    sums over all hosts goes to the driver."""
    hosts = materialize(rows.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.sum(over(r).cast("long")).alias(r) for r in RULES]), "hosts")
    sums = hosts.agg(
        F.count("*").alias("hosts"), F.sum("n_docs").alias("docs"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("squares"),
        *[F.sum(r).alias(r) for r in RULES]).first()
    docs = sums["docs"] or 0
    rates = {r: (sums[r] or 0) / docs if docs else 0.0 for r in RULES}
    spread = hosts.agg(*[F.sum(F.col("n_docs") * F.pow(F.col(r) / F.col("n_docs") - rates[r], 2)).alias(r)
                         for r in RULES]).first()
    out = ["host", "n_docs"]
    for r, mean in rates.items():
        chance = mean * (1 - mean)
        # Of the weighted spread, (hosts - 1) * chance is due to the hosts' sizes alone.
        room = docs - (sums["squares"] or 0) / docs if docs else 0.0
        between = max(0.0, ((spread[r] or 0.0) - max(0, sums["hosts"] - 1) * chance) / room) if room > 0 else 0.0
        strength = min(1e6, max(1.0, chance / between - 1)) if between > 0 else 1e6
        rate = (F.col(r) + mean * strength) / (F.col("n_docs") + strength)
        # A host is compared with the others; one that is alone, with itself.
        others = F.when(F.col("n_docs") < docs, ((sums[r] or 0) - F.col(r)) / (docs - F.col("n_docs"))).otherwise(F.lit(mean))
        out += [rate.alias(f"{r}_rate"), ((rate > SUSPECT_RATE) & (rate > 2 * others)).alias(f"{r}_suspect")]
    return hosts.select(*out)


def judged(docs: DataFrame, host: str | Column = "source", text: str = "text") -> DataFrame:
    """The columns of `docs`, the measures, base_failed, suspect_host and kept.

    A document is kept unless it fails a base rule or is over a rule's limit: the strict one if its
    host is suspect for the rule. Null hosts count as one host. An empty or null text has no words and
    fails. Rows are judged one by one, so repeated ids and rows get equal verdicts; an empty table
    gives no rows. New columns replace those of the same names.
    """
    column = F.col(f"`{host}`") if isinstance(host, str) else host
    new = [*MEASURES, "base_failed", "suspect_host", "kept"]
    own = [c for c in docs.columns if c not in new]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row"),
                         F.coalesce(column.cast("string"), F.lit("")).alias("host"),
                         F.col(f"`{text}`").cast("string").alias("__text"))
    rows = materialize(measured(packed, "__text").drop("__text"), "measured")
    verdicts = host_verdicts(rows)
    found = rows.join(verdicts.select("host", *[f"{r}_suspect" for r in RULES]), "host")
    bad = [over(r) | (F.col(f"{r}_suspect") & over(r, strict=True)) for r in RULES]
    suspect = [F.col(f"{r}_suspect") for r in RULES]
    found = (found.withColumn("base_failed", base_failed())
             .withColumn("suspect_host", F.greatest(*suspect))
             .withColumn("kept", ~F.col("base_failed") & ~F.greatest(*bad)))
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in own], *new)


ORACLE = """
WITH split AS (
    SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\v\\f\\r]')) AS l
    FROM documents),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times
    FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3))),
repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM windows WHERE times > 1) GROUP BY doc_id),
measures AS (
    SELECT s.doc_id, host, len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[ \\t\\n\\v\\f\\r]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
           len(l) AS n_lines, length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
           length(t) - length(replace(t, '!', '')) AS n_exclaims
    FROM split s LEFT JOIN repeats r USING (doc_id)),
ruled AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures),
long AS (
    SELECT doc_id, host, unnest([
        {'rule': 'symbols', 'over': n_symbols > 0.1::DOUBLE * n_words, 'strict': n_symbols > 0.05::DOUBLE * n_words},
        {'rule': 'shouting', 'over': n_capitals > 0.5::DOUBLE * word_chars, 'strict': n_capitals > 0.3::DOUBLE * word_chars},
        {'rule': 'exclaiming', 'over': n_exclaims > 0.1::DOUBLE * n_words, 'strict': n_exclaims > 0.05::DOUBLE * n_words},
        {'rule': 'dup_lines', 'over': n_dup_lines > 0.5::DOUBLE * n_lines, 'strict': n_dup_lines > 0.4::DOUBLE * n_lines}
    ], recursive := true) FROM ruled),
hosts AS (SELECT host, rule, count(*) AS n, sum("over"::INT)::DOUBLE AS k FROM long GROUP BY ALL),
corpus AS (SELECT rule, sum(k) / sum(n) AS m, sum(k) AS all_k, count(*) AS hosts, sum(n) AS docs, sum(n::DOUBLE * n) AS squares FROM hosts GROUP BY rule),
spread AS (SELECT rule, sum(n * (k / n - m) * (k / n - m)) AS s FROM hosts JOIN corpus USING (rule) GROUP BY rule),
moments AS (
    SELECT rule, m, docs, all_k, m * (1 - m) AS chance, CASE WHEN docs - squares / docs > 0
        THEN greatest(0.0, (s - (hosts - 1) * m * (1 - m)) / (docs - squares / docs)) ELSE 0.0 END AS between_hosts
    FROM corpus JOIN spread USING (rule)),
priors AS (
    SELECT rule, m, docs, all_k, CASE WHEN between_hosts > 0 THEN least(1e6, greatest(1.0, chance / between_hosts - 1)) ELSE 1e6 END AS strength
    FROM moments),
suspects AS (
    SELECT host, rule, (k + m * strength) / (n + strength)
        > greatest(0.25, 2 * CASE WHEN n < docs THEN (all_k - k) / (docs - n) ELSE m END) AS suspect
    FROM hosts JOIN priors USING (rule)),
verdicts AS (
    SELECT doc_id, bool_or("over" OR suspect AND strict) AS bad FROM long JOIN suspects USING (host, rule) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM ruled JOIN verdicts USING (doc_id)
"""
