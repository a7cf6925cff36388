"""Operators that work text by text: extraction, chat, byte BPE, packing, fingerprints."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import byte_bpe, chat, html_text, order_minhash, packing
from tidewire.llm.arrow import Memo, cut_at_spaces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS_50K = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", " \n", "é", "ß", "中", "1", "23", "'s", "!", "the", " of", "😀", "\x1c", " ", "ing", "<|endoftext|>"]
mixed = st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join)


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.one_of(mixed, st.text(max_size=40)))
@settings(max_examples=300, deadline=None)
def test_cuts_join_to_the_text(text):
    assert "".join(cut_at_spaces(text)) == text


@given(text=st.one_of(mixed, st.text(st.characters(codec="utf-8"), max_size=40)))
@settings(max_examples=300, deadline=None)
def test_bpe_ids_are_the_library_s(text):
    vocabulary = byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("l", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    ids = np.frombuffer(b"".join(next(Memo(vocabulary.encode_chunks).resolve([cut_at_spaces(text)]))), "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    assert b"".join(vocabulary.tokens[i] for i in ids) == text.encode()


def test_memo_keeps_bounded_and_right():
    memo = Memo(lambda xs: [x.upper() for x in xs], size=10)
    for i in range(50):
        assert list(memo.resolve([[str(i), "a"], [], ["b" * 100]])) == [[str(i), "A"], [], ["B" * 100]]
    assert len(memo.now) + len(memo.before) < 40


def test_bpe_on_awkward_documents(docs, none, library):
    encoded = byte_bpe.bpe_encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.bpe_decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.bpe_encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_added_tokens_are_encoded_as_the_library_does():
    end, tokenizer = "<|endoftext|>", Tokenizer.from_file(JSON)
    texts = [
        end, f"{end} hi", f"hi {end}", f"hi{end}hi", f"a {end} b", f"{end}{end}", f"{end} {end}", f"  {end}  \n{end}x", "", "<|endoftext", "no token here",
        f"日本 {end} 語", f"one two  three {end} {'word ' * 3000}", "<|im_end|>", "&lt;|endoftext|>", "<|endoftext|", "|endoftext|>",
    ]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in packing.encoded_texts(texts, JSON, RANKS_50K)]
    assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert got[0] == [50256]


def test_parts_encoded_together_get_their_own_ids():
    library = tiktoken.Encoding("l", pat_str=RANKS_50K[1], mergeable_ranks=byte_bpe.vocabulary(*RANKS_50K).ranks, special_tokens={})
    encode, rng = packing.rank_encoder(*RANKS_50K), random.Random(4)
    odd = [*ALPHABET, "\r", "\x85", "\xa0", "'", "'ll", "a" * 700]
    for _ in range(1_000):
        parts = [part for _ in range(3) for part in cut_at_spaces("".join(rng.choices(odd, k=rng.randint(0, 9))))]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(parts)] == list(map(library.encode_ordinary, parts))
    assert encode([]) == []


def test_latin_texts_are_encoded_as_the_library_does():
    tokenizer, rng = Tokenizer.from_file(JSON), random.Random(5)
    latin = [chr(code) for code in range(0x250)]
    texts = [f"a{c}b {c}{c} {c}1 \n{c} '{c}s  {c}\t {c}" for c in latin]
    texts += ["".join(rng.choices([*latin, *[x for x in ALPHABET if max(x) < "\u0250"]], k=40)) for _ in range(500)]
    texts += [text + " 中 " + text for text in texts[::7]]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in packing.encoded_texts(texts, JSON, RANKS_50K)]
    assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("text", ["a" + " " * 1_500_000 + "b", "語 b" + "\n" * 1_500_000])
def test_long_runs_of_white_space_are_encoded(text):
    (ids,) = packing.encoded_texts([text], JSON, RANKS_50K)
    assert np.frombuffer(ids, "<u4").tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("begin", ["one", "語"])
def test_packing_remembers_little(begin):
    packing._memo.cache_clear()
    list(packing.encoded_texts([begin], JSON, RANKS_50K))
    tracemalloc.start()
    for i in range(30):
        list(packing.encoded_texts([" ".join([begin, *(f"word{i}x{k}" for k in range(20_000))])], JSON, RANKS_50K))
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 6e7


def test_packing_keeps_every_id_and_every_limit(docs, none):
    tokenizer = Tokenizer.from_file(JSON)
    rows = packing.pack_documents(docs.where("doc_id is not null"), JSON, packing.Limits(), ranks=RANKS_50K).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}
    copies = docs.where("doc_id is not null").groupBy("doc_id").count().collect()
    assert set(by_doc) == set(texts)
    for r in copies:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[r.doc_id], key=lambda p: p.piece)[::r["count"]]
        assert len(by_doc[r.doc_id]) == len(pieces) * r["count"]
        at = 0
        for k, p in enumerate(pieces):
            assert (p.piece, p.start) == (k, at)
            assert k == 0 or p.length == 2048
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert packing.pack_documents(none, JSON).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_vector_limits_hold_and_bins_are_few(rule):
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 100) for _ in range(600)), reverse=True)
    limits = packing.Limits(100, 4, 6_000, rule=rule) if rule == "dot" else packing.Limits(100, 600, 10_000, rule=rule)
    lengths = [x for x in lengths if x * x <= limits.attention]
    sequence, offset = packing.pack_block(lengths, limits)
    for s in set(sequence.tolist()):
        inside = [x for x, y in zip(lengths, sequence) if y == s]
        assert sum(inside) <= 100 and len(inside) <= limits.documents and sum(x * x for x in inside) <= limits.attention
    if rule == "norm":
        assert len(set(sequence.tolist())) <= sum(lengths) / 100 * 1.03 + 1
    with pytest.raises(ValueError):
        packing.pack_block([101], limits)


def test_html_main_text():
    page = """<html><head><title>T</title><script>var t="</p>";</script></head><body><header>Top</header><nav><a href=x>Menu</a></nav>
    <div class="cookie-notice">We use cookies on this site and you agree to them by reading on.</div><div class="ad">Buy this very good thing now today.</div>
    <article><h1>Head &amp; line</h1><p>First   para <b>bold</b><br>next &eacute;<p>Second<aside>side</aside></p>
    <ul><li>item<li>item two</ul><form>form</form><!-- note --><section id="comments"><p>Reader says a lot of things here</p></section></article>
    <div class="sidebar">side</div><footer>&copy; foot</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line First para bold next é Second item item two"
    loose = "<body><div><a href=1>one</a> <a href=2>two</a></div>" + "".join(
        f"<div><p>{'A sentence of the text with many words in it. ' * 4}{i}</p></div>" for i in range(5)) + "<div><a href=3>three</a></div>"
    text = html_text.main_text(loose)
    assert text.startswith("A sentence") and text.endswith("4") and "one" not in text and "three" not in text
    assert html_text.main_text("") == "" and html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("plain words") == "plain words"


def test_html_on_awkward_rows(docs, none):
    rows = html_text.extract_main_text(docs.withColumnRenamed("text", "html")).collect()
    assert len(rows) == docs.count() and all(r.text is not None for r in rows)
    assert html_text.extract_main_text(none.withColumnRenamed("text", "html")).count() == 0


@given(st.text(st.sampled_from("<|\\im_end>\nab start"), max_size=40), st.text(st.sampled_from("<|\\\n>n"), max_size=10))
@settings(max_examples=300, deadline=None)
def test_chat_text_and_role_come_back(text, role):
    message = chat.render_message(role, [{"kind": "text", "text": text[:5]}, {"kind": "text", "text": text[5:]}])
    out = chat.assemble([message, message], frozenset([role]))
    read = chat.read_back(out["formatted"], out["loss"])
    assert read == {"turns": [{"role": role, "text": text}] * 2, "loss_text": text * 2}


def test_chat_parts_and_attachments(spark):
    null = F.lit(None)
    rows = spark.createDataFrame([(1, 1, "assistant", "b<|x"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, "user", "q")],
                                 "conv_id int, turn int, role string, text string")
    image = chat.part("image", ref=F.lit("img://1"), width=F.lit(57), height=F.lit(28))
    parts = rows.withColumn("parts", F.when(F.col("conv_id") == 1, F.array(
        chat.part("text", text=F.col("text")), image, chat.part("audio", ref=F.lit("a"), seconds=F.lit(2.0)),
        chat.part("text", text=F.lit("tail")), chat.part("document", ref=null, pages=F.lit(2)))))
    one, two = chat.parse_chats(chat.format_chats(parts)).orderBy("conv_id").collect()
    assert [t.role for t in one.turns] == ["", "user", "assistant"]
    assert one.turns[1].text == "a<|image:3|><|audio:4|>tail<|document:5|>"
    assert [a["index"] for a in one.attachments] == list(range(9))
    assert [a["tokens"] for a in one.attachments[:3]] == [3, 25, 512] and one.expanded_tokens == 3 * 540
    assert one.loss_text == "b<|xtail"
    assert two.turns[0].text == "" and two.loss_text == "" and two.n_turns == 1
    assert chat.format_chats(parts.where("false")).count() == 0
    with pytest.raises(ValueError):
        chat.render_message("user", [{"kind": "video"}])


def test_fingerprints(docs, none):
    rows = order_minhash.fingerprints(docs).collect()
    assert len(rows) == docs.count() and all(len(r.fingerprint) == 64 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text, set()).add(tuple(r.fingerprint))
    assert all(len(v) == 1 for v in by_text.values())
    assert set(by_text[None]) == set(by_text[""]) == {(0,) * 64}
    assert order_minhash.fingerprints(none).count() == 0


def test_fingerprint_is_that_of_a_plain_program(spark):
    """Occurrence numbers, order and wrap-around, with the hashes taken from Spark."""
    text = "a b a b a b c d e f g a b"
    tokens = text.split()
    grams = [(tokens[i], tokens[i + 1]) for i in range(len(tokens) - 1)]

    def hashed(*values, kind):
        row = spark.createDataFrame([values], kind).select(F.xxhash64(*[f"c{i}" for i in range(len(values))]).alias("h")).first()
        return row.h

    seen, items = {}, []
    for at, gram in enumerate(grams):
        n = seen[gram] = seen.get(gram, -1) + 1
        h = hashed(*gram, kind="c0 string, c1 string") >> 24
        items.append((hashed(h, n, kind="c0 bigint, c1 int") >> 24, at))
    ring = sorted(items)
    expected = []
    for c in range(64):
        begin = next((i for i, (h, _) in enumerate(ring) if (h >> 34) + 32 >= c), 0)
        two = sorted((at, h) for h, at in (ring[(begin + j) % len(ring)] for j in range(2)))
        value = spark.createDataFrame([([h & (1 << 40) - 1 for _, h in two],)], "a array<bigint>").select(F.xxhash64("a").alias("h")).first().h
        expected.append((value & 0xFFFFFFFF) - (1 << 31))
    got = spark.createDataFrame([(text,)], "text string").select(order_minhash.fingerprint(F.col("text")).alias("f")).first().f
    assert got == expected


def test_next_rows(spark, docs, none):
    rows = [(i * i, f"t{i}") for i in range(500)] + [(4, "again"), (None, "first")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_slice", F.lit("clash"))
    got = order_minhash.with_next(df, "doc_id", ["text"], 3).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = {(a, b[1]) for a, b in zip(order, order[1:] + order[:1])}
    assert {((r.doc_id, r.text), r.next_text) for r in got} == expected and len(got) == len(rows)
    assert order_minhash.with_next(none, "doc_id", ["text"]).count() == 0
    one = order_minhash.with_next(df.limit(1), "doc_id", ["text"]).first()
    assert one.next_text == one.text


def test_edits_lower_likeness(spark):
    base = [f"w{i % 170}" for i in range(400)]
    moved = base[200:] + base[:200]
    half = base[:200] + [f"v{i}" for i in range(200)]
    texts = [" ".join(x) for x in (base, base, moved, half, [f"u{i}" for i in range(400)])]
    prints = [r.f for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(
        order_minhash.fingerprint(F.col("t")).alias("f")).collect()]
    same = [sum(a == b for a, b in zip(prints[0], p)) / 64 for p in prints]
    assert same[1] == 1 and same[4] == 0 and 0 < same[3] < 0.6 and same[2] < 1


def test_digest_of_edited_text(spark, tmp_path):
    from tidewire.llm.queries import QUERIES

    texts = [(3, "abcdefgh"), (1, "12"), (7, None), (9, "ünïcödé 😀 text here")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op1_document_fingerprints"](spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in texts)
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        q = len(t) // 4
        assert rows[i].edited_sha256 == hashlib.sha256((t[:len(t) - q] + u[:q]).encode()).hexdigest()
        assert rows[i].n_chars == len(t) and 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
