"""Merkle manifest, removal of repeated passages, prefix trie: against plain programs, and the queries against their SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import edges
from tidewire.llm import merkle, prefix_trie, recompression
from tidewire.llm.arrow import Memo
from tidewire.llm.queries import ORACLES, QUERIES
from tidewire.llm.structure_queries import FIELDS

TALKS = "conv_id bigint, turn bigint, role string, text string, place string, seq int, name string, depth string, token int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def talk_rows(seed=3, n=70):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 4, 7, 9])):
            first = t == 0 and rng.random() < 0.7
            text = "hello there" if first else rng.choice(["a b", "a  b c", "", None, "ü\x0bü", "x" * 300])
            out.append((c, t, rng.choice(["user", "assistant"]) if not first else "user", text))
    out += [(100, t, "user", "again and again") for t in range(40)]  # a long one, and one with the same start
    out += [(101, t, "user", "again and again") for t in range(33)]
    out += [(102, None, None, None), (102, 5, None, "x"), (102, 5, None, "w"), (None, 1, "user", "nobody's"), (103, 0, "us", "er")]
    out += [out[0], out[0]]
    return [(*r, "p", 7, "n", "d", 1) for r in out]


@pytest.fixture(scope="module")
def awkward(spark, docs, tmp_path_factory):
    """A folder of tables with every awkward row."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(talk_rows(), TALKS).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    docs.where("false").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], TALKS).write.parquet(f"{folder}/conversations.parquet")
    return folder


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_substring_dedup", "op13_prefix_trie"])
def test_queries_on_awkward_tables(spark, awkward, empty, name):
    ours = QUERIES[name](spark, awkward)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{awkward}/{table}.parquet/*.parquet')")
    theirs = con.execute(ORACLES[name])
    assert rows_of(ours.columns, ours.collect()) == rows_of([d[0] for d in theirs.description], theirs.fetchall())
    assert QUERIES[name](spark, empty).collect() == []


# Merkle manifest

@pytest.mark.parametrize("height", [1, 2, 3, 4, 7, 11])
def test_addresses_fill_the_block(height):
    levels = merkle.places(height)
    assert sorted(x for level in levels for x in level) == list(range((1 << height) - 1))
    assert levels[-1] == [0]
    if height > 2:  # the upper half of the levels stands first, the first lower block right behind it
        upper = height // 2
        assert sorted(x for level in levels[height - upper:] for x in level) == list(range((1 << upper) - 1))
        lower = height - upper
        first = [x for k in range(lower) for x in levels[k][:1 << (lower - 1 - k)]]
        assert sorted(first) == list(range((1 << upper) - 1, (1 << upper) + (1 << lower) - 2))


def plain_levels(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels


def plain_way(levels, place):
    out = []
    for level in levels[:-1]:
        out.append((place % 2, level[place ^ 1] if place ^ 1 < len(level) else ""))
        place //= 2
    return out


def plain_manifest(rows):
    """(key, group, digest, presented) -> sorted result rows."""
    groups = defaultdict(list)
    for key, group, digest, presented in rows:
        groups["" if group is None else "=" + group].append((key is not None, key or 0, digest, presented, key))
    names = sorted(groups, key=lambda g: g.encode())
    trees = {g: plain_levels([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in names}
    top = plain_levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for place, (_, _, digest, presented, key) in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            way = plain_way(trees[g], place) + plain_way(top, at)
            folded = presented or digest
            for odd, other in way:
                folded = sha(other + folded if odd else folded + other)
            out.append((key, digest, trees[g][-1][0], top[-1][0], sha("".join(x for _, x in way)), folded))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [2, 5], [16, 17, 64, 65, 1], [33, 4, 4, 4, 4, 4]])
def test_manifest_of_many_levels(spark, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "ROWS_PER_SLICE", 7)
    rows = []
    for g, size in enumerate(sizes):
        for k in range(size):
            digest = sha(f"{g} {k}")
            rows.append((k * 3, None if g == 1 else f"g{g}é", digest, sha("other") if k % 5 == 4 else None))
    rows += [rows[0], (None, "g0é", sha("null key"), None)]
    df = spark.createDataFrame(rows, "id long, grp string, d string, p string").repartition(5)
    manifest = merkle.build_manifest(df, "id", "grp", F.col("d"), F.col("p"))
    got = sorted((tuple(r) for r in merkle.prove(manifest).select("key", "leaf", "subroot", "root", "proof", "folded").collect()), key=repr)
    assert got == plain_manifest(rows)
    assert [r.root for r in manifest.root().collect()] == [got[0][3]]


def test_tampering_is_found(spark, awkward):
    out = QUERIES["op11_merkle_manifest"](spark, awkward).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{awkward}/documents.parquet").select(*FIELDS).collect()}
    assert len({r.root for r in out}) == 1
    for r in out:
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and docs[r.doc_id].n_chars is not None
        assert r.verified == (not changed) and (r.folded_root == r.root) == r.verified


# Repeated passages

def plain_repeats(rows, window):
    """(key, text) rows -> (kept text, number removed) in order."""
    least = {}
    low = -1 << 63
    for key, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1):
            at = tuple(w[i:i + window])
            least[at] = min(least.get(at, 1 << 63), low if key is None else key)
    out = []
    for key, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (low if key is None else key):
                gone.update(range(i, i + window))
        out.append((key, b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=repr)


def repeat_rows(seed, n):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) - 1)
                w += p[a:] if kind < 0.25 else p
            elif kind < 0.7:
                w += [rng.choice("ab")] * rng.randint(1, 30)  # runs
            else:
                w += [f"own{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(1, 30))]
        rows.append((rng.choice([i, i, i, 5, None]), None if i % 19 == 0 else " \t".join(w)))
    return rows + rows[:4]


@pytest.mark.parametrize("window", [1, 2, 7, 50])
def test_repeats(spark, window):
    rows = repeat_rows(window, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = recompression.remove_repeats(df, window).collect()
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in out), key=repr) == plain_repeats(rows, window)


def test_repeats_keep_clashing_columns(spark):
    schema = "doc_id long, text string, _key string, _row int, _doc int, name string, n_words string, place int, s1 int"
    df = spark.createDataFrame([(1, "a b c", "k", 1, 2, "n", "w", 3, 4), (2, "x a b c", "k", 1, 2, "n", "w", 3, 4)], schema)
    out = {r.doc_id: r for r in recompression.remove_repeats(df, 3).collect()}
    assert out[2].text == "x" and out[2].n_removed == 3 and out[2].n_words == 4 and out[1].text == "a b c"
    assert (out[2]["_key"], out[2]["_row"], out[2]["_doc"], out[2]["name"], out[2].place, out[2].s1) == ("k", 1, 2, "n", 3, 4)


def named(words):
    memo = Memo(recompression.word_names)
    return np.frombuffer(b"".join(b"".join(v) for v in memo.resolve([words])), dtype="<u8")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=12, max_size=80),
       st.lists(st.sampled_from([b"a", b"b", b"q"]), max_size=25), st.lists(st.sampled_from([b"a", b"b", b"q"]), max_size=25))
def test_interiors_do_not_depend_on_what_stands_around(core, before, after):
    def interior(words, at):
        names, _, low, high = recompression.recompress(named(words), np.zeros(len(words), dtype=int), len(core))
        return names[low[at]:high[at]].tolist()

    assert interior(core, 0) == interior(before + core + after, len(before))


def test_rounds_shorten_texts():
    rng = random.Random(5)
    words = [b"w%d" % rng.randint(0, 5000) for _ in range(20_000)]
    names, _, low, high = recompression.recompress(named(words), np.zeros(len(words), dtype=int), 50)
    assert len(names) < len(words) / 4 and (high > low).mean() > 0.98
    names, *_ = recompression.recompress(named([b"same"] * 20_000), np.zeros(20_000, dtype=int))
    assert len(names) == 1


def test_a_task_sends_a_hot_window_once(monkeypatch):
    monkeypatch.setattr(recompression, "WORDS_AT_ONCE", 400)
    passage = edges.words(60, 9)
    texts = [f"{passage} own{i} " + edges.words(30, 100 + i) for i in range(60)]
    doc = pa.StructArray.from_arrays([pa.array(texts)], names=["text"])
    key, row = pa.array(range(60, 0, -1)), pa.array(range(1000, 1060))
    asked = pa.Table.from_batches(recompression._name_asker(50, "text")(iter([pa.RecordBatch.from_arrays([key, row, doc], names=["_key", "_row", "_doc"])])))
    names = defaultdict(int)
    for n, known in zip(asked["name"].to_pylist(), asked["known"].to_pylist()):
        names[n] += known is None
    assert max(names.values()) <= 4  # until a portion holds two of them
    shared = pa.array([sorted(names)] * 60)
    batch = pa.RecordBatch.from_arrays([key, row, doc, shared], names=["_key", "_row", "_doc", "_names"])
    up = pa.RecordBatch.from_arrays([c.take(pa.array(range(59, -1, -1))) for c in batch.columns], names=batch.schema.names)
    rows = pa.Table.from_batches(recompression._window_asker(50, "text")(iter([up])))
    found = defaultdict(int)
    for s1, place in zip(rows["s1"].to_pylist(), rows["place"].to_pylist()):
        found[s1] += place is not None
    assert max(found.values()) <= 4


# Prefix trie

def plain_trie(paths):
    """{seq: list of (token, weight)} -> sorted node rows."""
    members, ends = defaultdict(list), defaultdict(list)
    for seq, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(seq)
        ends[tuple(path)].append(seq)
    out = []
    for node, seqs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = sum(not any(len(k) == len(m) + 1 and k[:len(m)] == m for k in below) for m in below)
        saved = sum((len(members[m]) - 1) * m[-1][1] for m in below if m)
        up = min(members[node[:-1]]) if node else None
        out.append((min(seqs), len(node), up, len(seqs), len(children), leaves, saved, sha(",".join(map(str, sorted(ends[node]))))))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie(spark, seed):
    rng = random.Random(seed)
    paths = {s: [(rng.choice("aab"), 3) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 9, 17]))] for s in range(-5, 60)}
    paths[7] = [("a", 3)] * 70
    paths = {s: [(t, ord(t) - 90) for t, _ in path] for s, path in paths.items()}
    items = [(s, i + 1, t.encode(), w, "x") for s, path in paths.items() for i, (t, w) in enumerate(path)]
    df = spark.createDataFrame(items, "seq long, place long, token binary, weight long, name string").withColumn("token", F.unhex(F.sha2("token", 256)))
    out = prefix_trie.prefix_trie(df.repartition(5), spark.createDataFrame([(s,) for s in paths], "seq long"))
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[1])) == sorted(plain_trie(paths), key=lambda r: (r[0], r[1]))


def test_ids_meet_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ids = random.Random(1).sample(range(-500, 5000), 1500)
    ends = spark.createDataFrame([(b"hot" if i % 3 else b"n%d" % (i % 10), i) for i in ids], "name binary, seq long").repartition(9)
    want = defaultdict(list)
    for i in sorted(ids):
        want[b"hot" if i % 3 else b"n%d" % (i % 10)].append(str(i))
    got = {bytes(r.name): r.ends for r in prefix_trie.end_digests(ends).collect()}
    assert got == {k: sha(",".join(v)) for k, v in want.items()}
