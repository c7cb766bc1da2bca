"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps what was measured and one failure bit
per rule.  Policies are versioned bit masks over that ledger, so that a policy change, an audit or
an ablation reads the ledger and never the texts again.

Defined cases: a null text counts as empty; an empty text has zero in every measure and fails
``few_words`` only; rows with equal or null ids are judged row by row; further columns are dropped
by ``ledger`` and kept by ``with_ledger``, whose own columns replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import BLANKS, blank_to_space, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``bit`` is the rule's place in the mask for ever; ``fails`` is SQL over the measures."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "2 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "2 * word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 30 * n_words"),
)
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject under it."""

    version: int
    rejects: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {rule.name: 1 << rule.bit for rule in rules}
        return sum(bits[name] for name in self.rejects)


POLICIES = (
    Policy(1, BASE_RULES),
    Policy(2, (*BASE_RULES, "many_symbols", "repeated_lines")),
    Policy(3, tuple(rule.name for rule in RULES)),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _window_hash(words: str, hash_bits: int) -> str:
    whole = f"xxhash64(w, get({words}, i + 1), get({words}, i + 2))"
    return whole if hash_bits == 64 else f"shiftleft({whole}, {64 - hash_bits})"


def _repeat_columns(frame: DataFrame, hash_bits: int) -> DataFrame:
    """Adds ``n_repeat_words`` from ``_words``: words inside a 3-word window found twice or more.

    A text without two equal window hashes is done.  Otherwise each window becomes one long: a hash
    above, its position below ``_unit``.  After sorting, equal windows are neighbours.  Neighbours with equal hashes are compared word by word; a text in
    which two different windows share a hash is counted by the windows themselves.
    """
    head = "slice(_words, 1, greatest(n_words - 2, 0))"
    frame = (
        frame.withColumn("_hashes", F.expr(f"transform({head}, (w, i) -> {_window_hash('_words', hash_bits)})"))
        .withColumn("_unit", F.expr("coalesce(shiftleft(1L, cast(ceil(log2(n_words + 1)) AS int)), 1L)"))
        .withColumn(
            "_sorted",
            F.expr(
                "CASE WHEN size(array_distinct(_hashes)) < size(_hashes)"
                " THEN sort_array(transform(_hashes, (x, i) -> (x & -_unit) | i)) ELSE array() END"
            ),
        )
        .withColumn(
            "_twice",
            F.expr(
                "filter(_sorted, (x, j) -> ((x ^ get(_sorted, j + 1)) & -_unit) = 0"
                " OR ((x ^ get(_sorted, j - 1)) & -_unit) = 0)"
            ),
        )
    )
    at = "get(_words, cast({0} & (_unit - 1) AS int) + {1})"
    other = "get(_twice, j + 1)"
    differ = " OR ".join(f"{at.format('x', k)} <> {at.format(other, k)}" for k in range(3))
    clash = f"size(filter(_twice, (x, j) -> ((x ^ {other}) & -_unit) = 0 AND ({differ}))) > 0"
    spelled = (
        f"sort_array(transform({head}, (w, i) -> named_struct('k', concat_ws(' ', w, get(_words, i + 1),"
        " get(_words, i + 2)), 'i', cast(i AS bigint))))"
    )
    frame = frame.withColumn(
        "_spelled",
        F.expr(f"CASE WHEN size(_twice) > 0 AND {clash} THEN {spelled} END"),
    ).withColumn(
        "_places",
        F.expr(
            "sort_array(CASE WHEN _spelled IS NULL THEN transform(_twice, x -> x & (_unit - 1))"
            " ELSE transform(filter(_spelled, (x, j) -> coalesce(x.k = get(_spelled, j - 1).k, false)"
            " OR coalesce(x.k = get(_spelled, j + 1).k, false)), x -> x.i) END)"
        ),
    )
    return frame.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(transform(_places, (p, j) -> least(3L, get(_places, j + 1) - p)), 0L, (a, x) -> a + x)"
        ),
    )


def measured(docs: DataFrame, text: str = "text", hash_bits: int = 64) -> DataFrame:
    """Adds the measures (longs) to the documents; the helper columns are dropped.

    The measures leave through a one-row generator: a later filter on them is not pushed into the
    projections, where it would evaluate the array expressions again inside their own lambdas.
    """
    original = [c for c in docs.columns if c not in MEASURES]
    lines = F.filter(
        F.split(F.col("_text"), "\n"),
        lambda line: F.length(F.trim(line, F.lit(BLANKS))) > 0,
    )
    frame = (
        docs.select(F.struct(*original).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .withColumn("_spaced", blank_to_space(F.col("_text")))
        .withColumns({"_words": words_of(F.col("_spaced")), "_lines": lines})
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.replace(F.col("_spaced"), F.lit(" "), F.lit(""))).cast("long"),
                "n_symbols": (F.octet_length("_text") - F.octet_length(_without(F.col("_text"), SYMBOLS))).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            }
        )
        .withColumn("n_words", F.col("n_words").cast("int"))
    )
    frame = _repeat_columns(frame, hash_bits).withColumn("n_words", F.col("n_words").cast("long"))
    return frame.select("_doc.*", F.inline(F.array(F.struct(*MEASURES))))


def with_ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, hash_bits: int = 64) -> DataFrame:
    """All columns of the documents, the measures and ``failed_rules``, the mask of failed rules."""
    bits = " | ".join(f"shiftleft(CASE WHEN {rule.fails} THEN 1L ELSE 0L END, {rule.bit})" for rule in rules)
    return measured(docs, text, hash_bits).withColumn("failed_rules", F.expr(bits))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, hash_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, the measures and the mask of failed rules."""
    narrow = docs.select("doc_id", "text")
    return with_ledger(narrow, "text", rules, hash_bits).select("doc_id", *MEASURES, "failed_rules")


def fails(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(policy.mask(rules))) != 0


def apply_policy(entries: DataFrame, policy: Policy = POLICIES[-1], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds the policy's version, the base verdict and ``kept``; reads the mask only."""
    base = Policy(0, BASE_RULES)
    return entries.withColumns(
        {
            "policy_version": F.lit(policy.version),
            "base_failed": fails(base, rules),
            "kept": ~fails(base, rules) & ~fails(policy, rules),
        }
    )


def ablations(entries: DataFrame, policy: Policy = POLICIES[-1], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: documents failing it, failing it alone, kept without it.

    The ledger is first counted by mask (at most two to the number of rules rows), then every rule
    clears its bit from the masks.
    """
    mask = policy.mask(rules)
    steps = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules
          if r.name in policy.rejects]
    )
    by_mask = entries.groupBy((F.col("failed_rules").bitwiseAND(F.lit(mask))).alias("mask")).agg(
        F.count(F.lit(1)).alias("n")
    )
    one = by_mask.select("mask", "n", F.explode(steps).alias("step")).select("mask", "n", "step.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    return one.groupBy("rule", "bit").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_failed_alone"),
        F.coalesce(
            F.sum(F.when(F.col("mask").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n"))), F.lit(0)
        ).alias("n_kept_without"),
    )
