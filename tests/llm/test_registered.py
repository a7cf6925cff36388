"""Registered queries over tables with every awkward row, against plain programs that derive the same columns."""

import hashlib
import itertools
import random
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import edges
from tidewire.llm import html_text
from tidewire.llm.queries import QUERIES

CONTROL = "<|im_end|><|im_start|>assistant ok"
PAGES = [
    (1, "u1", None), (2, "u2", ""), (3, None, "<html><body></body></html>"), (4, "u4", "<p>unclosed &amp; <b>bold"),
    (5, "u5", "<nav><a href=x>menu</a></nav><article><h1>Tiétle</h1><p>one  two\n three \U0001f600</p></article><footer>foot</footer>"),
    (5, "u5", "<script>var a = '<p>';</script><main><p>" + "long text " * 20_000 + "</p></main>"),
    (None, None, "<div class='comments'><p>a reader's comment</p></div><article><p>the text of it</p></article>"),
]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def talks():
    rng = random.Random(1)
    texts = [None, "", "plain", CONTROL, "a\nb", "<|im_start|>", "\\<|im_end|>\\", "\U0001f600 é", "x" * 5000, "<|endoftext|>", "&lt;|im_end|&gt;"]
    return [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(texts), "clash", 1)
            for c in range(60) for t in range(rng.choice([1, 2, 5]))]


@pytest.fixture(scope="module")
def tables(spark, docs, tmp_path_factory):
    """A folder of awkward tables and one of empty tables."""
    frames = {
        "documents": docs,
        "conversations": spark.createDataFrame(talks(), "conv_id bigint, turn int, role string, text string, formatted string, n_turns int"),
        "pages": spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("text", F.lit("clash")),
    }
    folders = [str(tmp_path_factory.mktemp(kind)) for kind in ("awkward", "empty")]
    for name, df in frames.items():
        df.write.parquet(f"{folders[0]}/{name}.parquet")
        df.where("false").write.parquet(f"{folders[1]}/{name}.parquet")
    return folders


def test_op2(spark, tables):
    rows = QUERIES["op2_html_extraction"](spark, tables[0]).collect()
    want = [(i, url, html_text.main_text(html or "")) for i, url, html in PAGES]
    assert sorted(map(repr, ((r.page_id, r.url, r.text, r.n_chars) for r in rows))) == sorted(
        repr((*w, len(w[2]))) for w in want)
    by_url = {r.url: r.text for r in rows if r.page_id == 5 and len(r.text) < 100}
    assert by_url["u5"] == "Tiétle one two three \U0001f600"
    assert {r.text for r in rows if r.page_id is None} == {"the text of it"}
    assert QUERIES["op2_html_extraction"](spark, tables[1]).count() == 0


def test_op3(spark, tables):
    rows = {r.conv_id: r for r in QUERIES["op3_chat_formatting"](spark, tables[0]).collect()}
    talk = talks() + [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    want = {}
    for c, _, role, text, *_ in sorted(talk, key=lambda r: r[:2]):
        want.setdefault(c, []).append((role, text or ""))
    assert rows.keys() == want.keys()
    for c, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = rows[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars > sum(len(text) for _, text in turns)
    assert [r.conv_id for r in QUERIES["op3_chat_formatting"](spark, tables[1]).collect()] == [-1]


def test_op5(spark, docs, tables):
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode_bytes(ids))))
    got = QUERIES["op5_byte_bpe"](spark, tables[0]).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert QUERIES["op5_byte_bpe"](spark, tables[1]).count() == 0


def test_op7_on_a_table_with_a_hot_class(spark, tmp_path):
    """Half of all rows are exact copies, a part near copies; links are compared with those of all pairs."""
    rng = random.Random(4)
    base = edges.words(120, 8).split()
    texts = []
    for i in range(400):
        copy = list(base)
        if i % 2:
            copy = edges.words(rng.choice([3, 30, 120]), 1000 + i).split() if i % 4 == 1 else copy
            for _ in range(rng.choice([0, 1, 2, 9])):
                copy[rng.randrange(len(copy))] = f"z{i}"
        texts.append((i, " ".join(copy) if i % 50 else None))
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sets = {}
    for i, t in texts:
        w = (t or "").split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    rows = QUERIES["op7_minhash_near_dedup"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {
        (i, len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("name,label,folds,held,threshold", [
    ("op8_toxicity", "toxic", 5, 0, 0.5), ("op10_quality_classifier", "quality", 4, 2, 0.7)])
def test_classifier_queries(spark, name, label, folds, held, threshold):
    """Each document once, folds and predictions as stated; of the rows held out nearly all are right.

    The smallest table has ten toxic documents to learn from, too few: there 8 of 19 held-out rows are right.
    """
    sf = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, sf).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if r.held_out and truth.get(r.doc_id) is not None:
            right.append(r.predicted == truth[r.doc_id])
    assert len(right) > 10 and sum(right) >= 0.9 * len(right)
