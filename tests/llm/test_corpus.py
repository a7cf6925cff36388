"""Operators that compare documents: line removal, near duplicates, linked groups, search, classifiers, the pipeline."""

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edges import words
from tidewire.llm import crf, labelled, linked_groups, near_dedup, quality, search, spread_lines, toxicity
from tidewire.session import new_run_folder


def plain_removal(rows, min_sites):
    """(doc_id, text, source) rows with distinct ids -> texts after removal, by id."""
    sites, first = {}, {}
    for i, t, s in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            core = line.strip(" \t\r\f\v")
            if core:
                sites.setdefault(core, set()).add(s)
                first.setdefault(core, (i, k))
    return {i: None if t is None else "\n".join(
        line for k, line in enumerate(t.split("\n"))
        if not (c := line.strip(" \t\r\f\v")) or len(sites[c]) < min_sites or first[c] == (i, k)) for i, t, _ in rows}


@pytest.mark.parametrize("min_sites", [2, 5, 60])
def test_spread_lines(spark, min_sites):
    rng = random.Random(min_sites)
    rows = []
    for i in range(300):
        lines = [rng.choice(["common", " common\t", f"line {rng.randint(0, 40)}", f"own {i}", "", "  "]) for _ in range(rng.randint(0, 12))]
        rows.append((i, "\n".join(lines) if i % 50 else None, None if i % 17 == 0 else f"site{rng.randint(0, 80)}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = spread_lines.remove_spread_lines(df, min_sites)
    assert {r.doc_id: r.text for r in out.collect()} == plain_removal(rows, min_sites)


def test_spread_lines_on_awkward_documents(docs, none):
    out = spread_lines.remove_spread_lines(docs, 2).collect()
    assert len(out) == docs.count() and out[0].asDict().keys() == {*docs.columns, "n_removed"}
    assert spread_lines.remove_spread_lines(none).count() == 0


def plain_components(texts, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b]:
            n = len(sets[a] & sets[b])
            if n * 100 >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("percent,rows", [(85, 8), (80, 7)])
def test_near_duplicates(spark, percent, rows):
    rng = random.Random(percent)
    texts = {}
    for g in range(12):
        base = words(rng.choice([3, 5, 40, 200]), g).split()
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(0, len(base) // 60))):
                copy[rng.randrange(len(copy))] = f"z{rng.random()}"
            base = copy if rng.random() < 0.5 else base  # chains of edits
            texts[len(texts)] = " ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy)
    texts[len(texts)], texts[len(texts)] = None, ""
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, percent, rows).collect()}
    assert got == plain_components(texts, percent)


def test_near_duplicates_on_awkward_documents(docs, none):
    out = near_dedup.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert by_id[7] == {(6, False)} and by_id[50] == {(6, False)} and by_id[10] == {(9, False)}
    assert by_id[0] == {(0, True)} and by_id[2] == {(2, True)} and by_id[None] == {(None, True)}
    assert near_dedup.near_duplicates(none).count() == 0


def test_bands_miss_rarely():
    for percent, rows in ((85, 8), (80, 7)):
        assert (1 - (percent / 100) ** rows) ** near_dedup.bands_for(percent, rows) < 1e-6


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [
        (rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    df = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "a bigint, b bigint")
    got = {r.node: r.root for r in linked_groups.group_roots(df, new_run_folder(spark, "test")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def plain_search(texts, queries, k):
    terms = {i: Counter(re.findall(r"\w+", (t or "").lower())) for i, t in texts.items()}
    size = {i: sum(c.values()) for i, c in terms.items()}
    average = max(1.0, sum(size.values()) / len(texts))
    df = Counter(w for c in terms.values() for w in c)
    out = {}
    for q in queries:
        scores = []
        for i, c in terms.items():
            s = sum(n * math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2
                    / (c[w] + 1.2 * (0.25 + 0.75 * size[i] / average)) for w, n in terms[q].items() if w in c)
            if s > 0:
                scores.append((-round(s, 6), i))
        out[q] = sorted(scores)[:k]
    return out


def test_search_is_exact(spark, monkeypatch, docs, none):
    monkeypatch.setattr(search, "SHARD_DOCS", 200)
    monkeypatch.setattr(search, "QUERY_BLOCK", 5)
    monkeypatch.setattr(search, "PART_POSTINGS", 3_000)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(0, 60))) for i in range(400)}
    texts[7] = None
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {}
    for r in search.search(df, df.where("doc_id % 50 = 0"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-round(r.score, 6), r.doc_id))
    expected = plain_search(texts, range(0, 400, 50), 7)
    assert got == {q: hits for q, hits in expected.items() if hits}
    assert search.search(docs, docs, k=2).where("rank = 1").count() > 8
    assert search.search(none, none).count() == 0


def test_search_shuffles_neither_postings_nor_copies_of_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 20)
    monkeypatch.setattr(search, "QUERY_BLOCK", 5)
    df = spark.createDataFrame([(i, words(20, i)) for i in range(100)], "doc_id bigint, text string").repartition(2)
    found = search.search(df, df.where("doc_id % 5 = 0"), k=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CartesianProduct") == 1 and "Exchange" not in plan.split("CartesianProduct")[1]
    assert "shard" not in "".join(line for line in plan.split("\n") if "Exchange" in line)
    assert found.where("rank = 1 and doc_id = query_id").count() == 20


def test_copies_score_alike_in_every_shard(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 7)
    texts = [(i, words(30, 1) if i % 3 else words(30, i)) for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    found = search.search(df, df.where("doc_id = 1"), k=25).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [i for i in range(90) if i % 3][:25]
    assert len({r.score for r in found}) == 1


def test_search_tasks_meet_several_shards(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 2)
    df = spark.createDataFrame([(i, words(20, i)) for i in range(120)], "doc_id bigint, text string").repartition(60)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # each of the 60 files is read on its own
    try:
        found = search.search(df, df.where("doc_id % 5 = 0"), k=3)
        plan = found._jdf.queryExecution().executedPlan().toString().split("CartesianProduct")[1]
        tasks = math.prod(int(n) for n in re.findall(r"Coalesce (\d+)", plan))
        assert plan.count("Coalesce") == 2 and tasks <= 4 * spark.sparkContext.defaultParallelism
        assert found.where("rank = 1 and doc_id = query_id").count() == 24
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scores_closer_than_single_precision_keep_their_order():
    import pyarrow as pa

    n_docs, terms = 40, np.array([3, 5, 9])
    packed = [pa.array([x.astype(kind).tobytes()], pa.binary())[0] for x, kind in (
        (np.full(n_docs, 4), "<i8"), (terms, "<i8"), (np.array([20, 20, 2]), "<u1"),
        (np.array([*range(0, n_docs, 2), *range(1, n_docs, 2), 7, 8]), "<u1"), (np.ones(n_docs + 2), "<u1"))]
    weights = np.array([1.0, 1.0 + 1e-9, 1e-9, 1.0, 1.0 + 1e-9])  # of two queries
    for common in ([], [3, 5], [3, 5, 9]):
        index = search.ShardIndex(*packed, np.array(common, np.int64), 4.0)
        got = {}
        for hits in index.top(terms, np.array([0, 1, 2, 0, 1]), weights, np.array([3, 2]), 4, np.zeros(2)):
            for query, place, _ in zip(*hits):
                got.setdefault(int(query), []).append(int(place))
        assert got == {0: [7, 1, 3, 5], 1: [1, 3, 5, 7]}
        hits = list(index.top(terms, np.array([0, 1]), weights[3:], np.array([2]), 4, np.array([1.0 + 5e-10])))
        assert [int(place) for place in hits[0][1]] == [1, 3, 5, 7]


def test_products_and_postings_choose_the_same_documents(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n_docs, n_terms, n_queries, k = 300, 80, 70, 6
    tf = rng.integers(1, 9, (n_terms, n_docs)) * (rng.random((n_terms, n_docs)) < np.linspace(0.9, 0.01, n_terms)[:, None])
    tf[:, 250:] = tf[:, :50]  # copies
    lengths = np.maximum(1, tf.sum(axis=0))
    present = np.flatnonzero(tf.any(axis=1))
    packed = [pa.array([x.astype(kind).tobytes()], pa.binary())[0] for x, kind in (
        (lengths, "<i8"), (present * 3, "<i8"), ((tf > 0).sum(axis=1)[present], "<u2"),
        (np.concatenate([np.flatnonzero(row) for row in tf]), "<u2"), (tf[tf > 0], "<u1"))]
    asked = [np.sort(rng.choice(n_terms + 5, rng.integers(0, 40), replace=False)) for _ in range(n_queries)]
    weights = [rng.random(len(x)) * 5 for x in asked]
    average = lengths.mean()
    norm = 1.2 * (0.25 + 0.75 * lengths / average)
    part = np.vstack([tf * 2.2 / (tf + norm), np.zeros((5, n_docs))])
    scores = np.array([w @ part[x] for x, w in zip(asked, weights)])
    least = np.where(np.arange(n_queries) % 3 == 0, np.maximum(0, np.sort(scores, axis=1)[:, -3] - 1e-7), 0.0)
    for cost, added in ((0, 7), (search.POSTING_COST, search.ADDED_AT_ONCE), (1e9, 64)):
        monkeypatch.setattr(search, "POSTING_COST", cost)
        monkeypatch.setattr(search, "ADDED_AT_ONCE", added)
        monkeypatch.setattr(search, "GROUP", 16)
        monkeypatch.setattr(search, "TABLE_CELLS", 200)
        index = search.ShardIndex(*packed, np.arange(0, 90, 3), average)
        got = {}
        at, sizes = np.concatenate(asked).astype(np.int32), np.array([len(x) for x in asked], np.int32)
        for hits in index.top(np.arange(n_terms + 5) * 3, at, np.concatenate(weights), sizes, k, least):
            for query, place, score in zip(*hits):
                got.setdefault(int(query), []).append((int(place), round(float(score), 9)))
        for query in range(n_queries):
            best = sorted((-round(float(s), 9), i) for i, s in enumerate(scores[query]) if s > max(1e-9, least[query]))[:k]
            assert got.get(query, []) == [(i, -s) for s, i in best]


def test_queries_alike_stand_together(monkeypatch):
    monkeypatch.setattr(search, "GROUP", 25)
    rng = np.random.default_rng(1)
    kinds = rng.permutation(np.arange(100) % 2)
    has = rng.random((100, 40)) < np.where(np.arange(40) // 20 == kinds[:, None], 0.6, 0.1)
    order = search._alike_together(*np.nonzero(has), 100, 40)
    assert sorted(order) == list(range(100))
    assert all(len(set(kinds[order[i:i + 25]])) == 1 for i in range(0, 100, 25))


def test_words_of_ascii_texts_are_those_of_the_pattern():
    for text in ("".join(map(chr, range(128))), "A_b-C\x00d\x1fE 9", "", "caf\u00e9 \u0130x CAF\u00c9"):
        terms, lengths = search.text_terms([text])
        plain = search.text_terms([word + " \u00e9" for word in re.findall(r"\w+", text.lower())])[0]  # by the pattern, each with one more
        assert lengths.tolist() == [len(plain) // 2] and terms.tolist() == plain[::2].tolist()


def test_fitting_toxicity_keeps_the_model_only(monkeypatch):
    rows = [(words(400, i) + (" vile" if i % 2 else ""), i % 2) for i in range(60)]
    tracemalloc.start()
    model = toxicity.fit_toxicity(rows, rounds=2)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert model.tagger is not None and kept < 3e6  # three tables of 65,536 weights
    monkeypatch.setattr(toxicity, "FITTED_WORDS", 7)
    assert (toxicity.fit_toxicity(rows, rounds=2).tagger.own == model.tagger.own).all()


def test_field_marginals_are_those_of_all_labellings(monkeypatch):
    monkeypatch.setattr(crf, "STEPS", 4)
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 1, 9, 4, 5])
    emission, move = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2))
    p, counts, logz = crf.marginals(emission, lengths, move)
    at, expected, pairs = 0, [], np.zeros((2, 2))
    for n, z in zip(lengths, logz):
        here, total, sums, moves = emission[at:at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        at += n
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(np.dot(y, here) + sum(move[a, b] for a, b in zip(y, y[1:]))) if n else 1.0
            total += w
            sums += w * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[a, b] += w
        expected += list(sums / total)
        pairs += moves / total
        assert n == 0 or abs(z - np.log(total)) < 1e-9
    assert np.allclose(p, expected) and np.allclose(counts, pairs)
    again, none, _ = crf.marginals(emission, lengths, move, counted=False)
    assert np.array_equal(again, p) and not none.any()


@pytest.fixture(scope="module")
def labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def test_sample_is_bounded_and_repeatable(labelled_rows):
    docs, labels = labelled_rows
    one = labelled.sample(docs, labels, "toxic", per_class=(40, 30))
    two = labelled.sample(docs.repartition(7), labels, "toxic", per_class=(40, 30))
    assert one == two and Counter(y for _, y in one) == {0: 40, 1: 30}
    assert all(len(t) <= labelled.SAMPLE_CHARS for t, _ in one)


def held_out(scored, docs, labels, label, fold):
    known = labels.where(fold).select("doc_id", label)
    return scored.join(known, "doc_id").select(label, "score").collect()


def test_quality_on_held_out_rows(labelled_rows):
    docs, labels = labelled_rows
    fold = labelled.crc_fold("doc_id", 4)
    model = quality.learn_quality(docs, labels, fold != 2)
    scored = quality.score_quality(docs, model).select("doc_id", F.col("quality.score").alias("score"))
    rows = held_out(scored, docs, labels, "quality", fold == 2)
    kept = [r.score >= 0.7 for r in rows if r.quality == 1]
    passed = [r.score >= 0.7 for r in rows if r.quality == 0]
    assert sum(kept) >= 0.98 * len(kept) and sum(passed) <= 0.05 * len(passed)


def test_toxicity_on_held_out_rows(labelled_rows):
    docs, labels = labelled_rows
    fold = labelled.crc_fold("doc_id", 5)
    model = toxicity.learn_toxicity(docs, labels, fold != 0)
    scored = toxicity.score_toxicity(docs, model).select("doc_id", F.col("toxicity.score").alias("score"))
    rows = held_out(scored, docs, labels, "toxic", fold == 0)
    found = [r.score >= 0.5 for r in rows if r.toxic == 1]
    wrong = [r.score >= 0.5 for r in rows if r.toxic == 0]
    assert sum(found) >= 0.8 * len(found) and sum(wrong) <= 0.03 * len(wrong)


def test_word_features_do_not_depend_on_the_words_beside_them():
    kinds = ["Vile,", "v1le", "100", "$$$", "_", "a_b", "ẞtraße", "İstanbul", "ΣΑΣ", "ﬁne", "x²", "²", "日本語", "B4D!", "e\u0301t", "\u200d", "9a"]
    names = list(toxicity.words_names(kinds))
    assert names == [next(toxicity.words_names([w])) for w in kinds] and {len(row) for row in names} == {toxicity.WIDTH}
    assert names[0] == ("wvile", "3vil", "4vile", "", "", "", "", "sl4") and names[1][:3] == names[0][:3] and names[1][-1] == "sld4"
    assert names[2][0] == "w100" and names[3] == ("w", *[""] * 6, "sl0") and names[13][0] == "wbadi" and names[16][0] == "w9a"
    assert toxicity.word_features([]).shape == (0, toxicity.WIDTH)


def test_toxic_spans(spark):
    rng = random.Random(2)
    rows = [(f"{words(20, i)} {rng.choice(['nasty', 'Vile,'])} {words(5, -i)}" if i % 3 == 0 else words(25, i), int(i % 3 == 0)) for i in range(300)]
    model = toxicity.fit_toxicity(rows)
    df = spark.createDataFrame([("good words nasty here", 1), ("only good words", 2), (None, 3), ("", 4), ("x " * 20000 + "v1le", 5)], "text string, toxicity int")
    out = toxicity.score_toxicity(df, model).collect()
    found = {r.text: r.toxicity for r in out}
    span, = found["good words nasty here"].spans
    assert "good words nasty here"[span.start:span.stop] == "nasty" and found["good words nasty here"].score > 0.5
    assert found["only good words"].score < 0.5 and not found["only good words"].spans
    assert found[None].score == 0 and found[""].score == 0
    assert found["x " * 20000 + "v1le"].spans[0].start == 40000


def test_classifiers_on_awkward_documents(docs, none):
    good = quality.fit_quality([(words(30, i), 1) for i in range(20)] + [("A | B | C |", 0)] * 20)
    bad = toxicity.fit_toxicity([])
    for df, n in ((docs, docs.count()), (none, 0)):
        rows = quality.score_quality(df, good).collect()
        assert len(rows) == n and all(0 <= r.quality.score <= 1 for r in rows)
        rows = toxicity.score_toxicity(df, bad).collect()
        assert len(rows) == n and all(r.toxicity.score == 0 for r in rows)
    assert quality.fit_quality([]).share == 1.0


def test_pipeline_stages(spark, sf, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        if name == "line dedup":
            rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
            expected = {i: t for i, t in plain_removal(rows, 5).items() if t == dict((a, b) for a, b, _ in rows)[i] or (t or "").strip()}
            assert {r.doc_id: r.text for r in after.collect()} == expected
        if name == "MinHash near-dedup":
            expected = plain_components({r.doc_id: r.text for r in before.collect()}, 80)
            assert ids == {i for i, (_, root) in expected.items() if root == i}
        before = after
    assert corpus_pipeline.run(spark, sf).count() == before.count()
