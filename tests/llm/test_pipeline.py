"""The pipeline against a brute-force version on a small fixture, and its stages on odd input."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
from faultline.llm import mixing, packing
from tests.llm.test_layout_operators import shared
from tests.llm.test_ngram_join import expected, links, smallest_reachable
from tests.llm.test_quality_rules import measures

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SECRET = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""", re.I | re.A)


def fixture(seed=12):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(300)]
    rows = []
    for i in range(160):
        if rows and rng.random() < 0.4:
            tokens = rng.choice(rows)[1].split()
            if rng.random() < 0.7:
                tokens[rng.randrange(len(tokens))] = rng.choice(words)
        else:
            tokens = rng.choices(words, k=rng.choice([10, 60, 80, 150, 300]))
            if rng.random() < 0.2:
                tokens = (tokens[:7] * 40)[:120]
            if rng.random() < 0.3:
                tokens.insert(3, "password=abc12345 é AKIA" + "Q" * 16)
            if rng.random() < 0.1:
                tokens = [t + "***" for t in tokens]
        text = rng.choice([" ", "\n"]).join(tokens)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src3", "src12", None]), len(text)))
    return [*rows, (500, None, "en", "src0", 0), (501, "", None, None, 0)]


def brute(rows):
    def kept(text):
        n, chars, symbols, lines, twice, repeat = measures(text)
        return not (n < 50 or 2 * repeat > n or 2 * symbols > n or 2 * twice > lines or 2 * chars < 3 * n or chars > 30 * n)

    rows = [r for r in rows if kept(r[1])]
    label = {i: c for i, _, c in expected(rows)}
    rows = [r for r in rows if label[r[0]] == r[0]]
    rows = [(i, SECRET.sub("[secret]", text), lang, source) for i, text, lang, source, _ in rows]
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        domain = "(none)" if source is None else "web" if source == "src0" else "books" if len(source) == 4 else "reference"
        leaves[domain, lang or "(none)", source or "(none)"].append((i, text))
    supply = {leaf: sum(len(t.split()) for _, t in part) for leaf, part in leaves.items()}
    return rows, leaves, supply


def test_run_equals_brute_force(spark, tmp_path):
    rows = fixture()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    _, leaves, supply = brute(rows)
    recipe = mixing.Recipe()
    schema = "domain string, language string, origin string, supply long"
    frame = spark.createDataFrame([(*leaf, n) for leaf, n in supply.items()], schema)
    budgets = {(r.domain, r.language, r.origin): r.budget for r in mixing.leaf_budgets(frame, recipe).collect()}
    weights, caps = recipe.weights["domain"], defaultdict(int)
    for leaf, n in supply.items():
        caps[leaf[0]] += 2 * n
    ideal = shared(Fraction(sum(supply.values()) * 7 // 10), {d: weights.get(d, 1) for d in caps}, caps)
    for domain, share in ideal.items():
        assert abs(sum(b for leaf, b in budgets.items() if leaf[0] == domain) - share) <= 1
    pieces = Counter()
    for leaf, part in leaves.items():
        budget, epoch = budgets[leaf], 0
        while budget:
            order = sorted(part, key=lambda row: hashlib.md5(f"{recipe.seed}|{epoch}|{row[0]}".encode()).hexdigest())
            for doc_id, text in order if budget < supply[leaf] else part:
                n = min(budget, len(text.split()))
                budget -= n
                pieces.update((doc_id, k, 2048 * k, min(2048, n - 2048 * k)) for k in range(-(-n // 2048)))
            epoch += 1
    assert Counter((r.doc_id, r.piece, r.first_token, r.n_tokens) for r in got) == pieces
    lengths = Counter(r.n_tokens for r in got)
    bounds = packing.best_bounds(list(lengths), list(lengths.values()), packing.BUCKETS)
    assert all(r.padded_length == min(b for b in bounds if b >= r.n_tokens) for r in got)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame(fixture(), SCHEMA)
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, "")
        if place < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns and [t for _, t in result.dtypes] == [t for _, t in docs.dtypes]
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def five_word_labels(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    return smallest_reachable(ids, [(a, b) for n, a in enumerate(ids) for b in ids[:n] if links(sets[a], sets[b], Fraction(8, 10))])


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    rng = random.Random(4)
    rows = []
    for i in range(0, 90, 3):
        tokens = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 100, 200]))]
        edited, cut = list(tokens), len(tokens) * 8 // 100
        edited[20 : 20 + cut] = [f"x{rng.randrange(5000)}" for _ in range(cut)]
        scattered = list(tokens)
        for at in range(3, len(tokens), 12):
            scattered[at] = "y"
        rows += [(i + k, " ".join(t), "en", "src0", 1) for k, t in enumerate((tokens, edited, scattered))]
    label = five_word_labels(rows)
    assert label != {i: c for i, _, c in expected(rows)}
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in got) == [i for i in sorted(label) if label[i] == i]


def test_stages_keep_columns_named_like_their_own(spark):
    """A document's own columns come through every stage unchanged, whatever they are called."""
    names = ["n_words", "kept", "base_failed", "failed_rules", "rep", "sign", "component", "low", "tokens", "document", "size", "_doc"]
    docs = spark.createDataFrame(fixture(), SCHEMA)
    for name in names:
        docs = docs.withColumn(name, docs["doc_id"] * 10 + 7)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, "")
        assert result.columns == docs.columns
        rows = result.collect()
        assert rows and all(row[name] == row["doc_id"] * 10 + 7 for row in rows for name in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
