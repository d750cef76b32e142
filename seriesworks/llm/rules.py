"""Quality rules by weak supervision.

Every rule votes good (1), bad (-1) or abstains (0).  Votes are taken as independent
given the unknown quality; expectation-maximisation estimates each rule's accuracies and
the share of good documents from the counts of the vote patterns, of which there are at
most ``3 ** len(RULES)`` whatever the number of documents.  A document is kept if its
posterior probability of being good is at least one half.  All of it is DataFrame and
SQL work: one pass for the statistics, one row for the estimation, one equi-join on
the pattern code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import n_chars_of, word_array

#: Iterations, starting accuracy, and the votes that the starting accuracy is worth.
ITERATIONS, START, PRIOR_VOTES = 20, 0.9, 1.0
#: (name, SQL of "bad", SQL of "good"); a rule abstains where neither holds.
RULES = [
    ("length", "n_words < 20", "n_words >= 100"),
    ("word_length", "word_chars < 3 * n_words OR 10 * word_chars > 65 * n_words",
     "word_chars >= 4 * n_words AND word_chars <= 6 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "100 * n_symbols < n_words"),
    ("symbol_share", "100 * n_symbols > 3 * word_chars", "200 * n_symbols < word_chars"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    ("repetition", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    ("capitals", "10 * n_capitals > 3 * word_chars", "10 * n_capitals <= word_chars"),
    ("exclamation", "4 * n_exclamations > n_words", "20 * n_exclamations <= n_words"),
]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the windows of three words; null where there is at most one window."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return F.when(F.size(words) > 3, F.transform(starts, window))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules look at (all long); a null text counts as empty.

    Repeated words: windows of three words are sorted by hash and position, a window is
    repeated if a neighbour has the same hash, and it covers three words, or fewer up to
    the start of the next repeated one.
    """
    has_repeats = F.size(F.array_distinct("__sw_windows")) < F.size("__sw_windows")
    pair = lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    same = lambda x, k: F.get(F.col("__sw_sorted"), k)["h"] == x["h"]
    repeated = F.filter(
        "__sw_sorted",
        lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | ((k > 0) & F.coalesce(same(x, k - 1), F.lit(False))),
    )
    next_start = lambda x, k: F.least(F.lit(3), F.coalesce(F.get(F.col("__sw_starts"), k + 1), x + 3) - x)
    covered = F.aggregate(F.transform("__sw_starts", next_start), F.lit(0), lambda s, x: s + x)
    lines = F.filter(F.split("__sw_text", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    return (
        docs.withColumn("__sw_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("__sw_words", word_array(F.col("__sw_text")))
        .withColumn("__sw_lines", lines)
        .withColumn("__sw_windows", window_hashes(F.col("__sw_words")))
        .withColumn("__sw_sorted", F.when(has_repeats, F.sort_array(F.transform("__sw_windows", pair))))
        .withColumn("__sw_starts", F.sort_array(F.transform(repeated, lambda x: x["i"])))
        .withColumns({
            "n_words": F.size("__sw_words").cast("long"),
            "word_chars": F.length(F.translate("__sw_text", " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": n_chars_of(F.col("__sw_text"), "#*$%&|<>").cast("long"),
            "n_lines": F.size("__sw_lines").cast("long"),
            "n_dup_lines": (F.size("__sw_lines") - F.size(F.array_distinct("__sw_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "n_capitals": n_chars_of(F.col("__sw_text"), CAPITALS).cast("long"),
            "n_exclamations": n_chars_of(F.col("__sw_text"), "!").cast("long"),
        })
        .drop("__sw_text", "__sw_words", "__sw_lines", "__sw_windows", "__sw_sorted", "__sw_starts")
    )


def votes(rules=RULES) -> Column:
    """Array of the rules' votes, in their order."""
    return F.array(*(F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END") for _, bad, good in rules))


def code(rules=RULES) -> Column:
    """The vote pattern as one number, three values a rule."""
    return sum((F.get("votes", F.lit(j)) + 1) * 3**j for j in range(len(rules))).cast("long")


def estimate(patterns: DataFrame, n_rules: int, iterations: int = ITERATIONS) -> DataFrame:
    """Expectation-maximisation over (votes, n) patterns: adds ``posterior`` to each.

    Each rule has two accuracies: how often its votes on good documents say good, and
    how often those on bad ones say bad.  At the start a pattern with any bad vote is
    bad with probability ``START``, any other one good.  One row holds all patterns;
    its length is bounded by the number of rules.
    """
    evidence = (
        "CASE x.votes[j] WHEN 1 THEN ln(s.good[j] / (1 - s.bad[j])) WHEN -1 THEN ln((1 - s.good[j]) / s.bad[j]) ELSE 0D END"
    )
    rules = f"sequence(0, {n_rules - 1})"
    log_odds = f"ln(s.p / (1 - s.p)) + aggregate(transform({rules}, j -> {evidence}), 0D, (t, y) -> t + y)"
    row = lambda q: f"transform(rows, x -> named_struct('votes', x.votes, 'n', x.n, 'q', {q}))"
    expect = row(f"1 / (1 + exp(-({log_odds})))")
    start = row(f"CASE WHEN array_contains(x.votes, -1) THEN {1 - START}D ELSE {START}D END")
    total = lambda what: f"aggregate(r, 0D, (t, x) -> t + x.n * ({what}))"

    def accuracy(share: str, vote: int) -> str:
        said = total(f"CASE x.votes[j] WHEN {vote} THEN {share} ELSE 0D END")
        voted = total(f"abs(x.votes[j]) * {share}")
        return f"least(0.9999D, greatest(0.0001D, ({said} + {START * PRIOR_VOTES}D) / ({voted} + {PRIOR_VOTES}D)))"

    maximise = (
        f"named_struct('p', ({total('x.q')} + 1D) / ({total('1D')} + 2D),"
        f" 'good', transform({rules}, j -> {accuracy('x.q', 1)}), 'bad', transform({rules}, j -> {accuracy('(1 - x.q)', -1)}))"
    )
    first = f"aggregate(array({start}), CAST(NULL AS struct<p: double, good: array<double>, bad: array<double>>), (z, r) -> {maximise})"
    step = f"aggregate(array({expect}), s, (z, r) -> {maximise})"
    return (
        patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("rows"))
        .withColumn("s", F.expr(f"aggregate(sequence(1, {iterations}), {first}, (s, i) -> {step})"))
        .select(F.explode(F.expr(expect)).alias("x"), "s")
        .select("x.votes", F.col("x.q").alias("posterior"), F.col("s.p").alias("prior"), "s.good", "s.bad")
    )


def apply_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Statistics, votes and posterior quality of every document.

    Returns the columns of ``docs`` but the text, the statistics, ``votes`` (one per
    rule), ``posterior``, ``base_failed`` and ``kept``.  Null and empty texts have zero
    counts and fail the base check.  An empty table gives an empty result; repeated
    rows stay repeated.  The statistics are written once, since the estimation needs
    all of them before any row can be judged.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations",
           "votes", "code", "posterior", "base_failed", "kept"]
    counted = with_statistics(docs.drop(*[c for c in own if c != text]), text).drop(text)
    counted = cut_lineage(counted.withColumn("votes", votes(rules)).withColumn("code", code(rules)))
    patterns = counted.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    judged = estimate(patterns, len(rules)).withColumn("code", code(rules)).select("code", "posterior")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counted.join(F.broadcast(judged), "code")  # at most 3 ** len(rules) rows
        .drop("code")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    )
