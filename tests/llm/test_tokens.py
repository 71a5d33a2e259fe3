import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockweave.llm import packing, tokenfiles
from stockweave.llm.tokens import Encoder

ODD = [
    "",
    " ",
    "\n",
    "a",
    "two  spaces and\ttabs \n\n lines ",
    " leading",
    "it's we're 'tis O'Neil's\nend",
    "übergröße ÉCOLE naïve nbsp  em",
    "mark \x01 inside \x01\x01 and \x1c too",
    "<|endoftext|> in text <|startoftext|>",
    "hello <|endoftext|> world",
    "a<|endoftext|>b <|ENDOFTEXT|> and <b>bold</b> < 5",
    "don't ''s 'S I'LL we'd've x's' ('tis) a.b,c;12,345.67%% ~!@ CamelCase9a",
    "CRLF\r\nlines\r\n",
    "日本語 text 12345 $$$ ...",
]


def direct(path, text):
    t = Tokenizer.from_file(path)
    return t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["byte", "word"])
def test_word_by_word_ids_equal_whole_text_ids(which, byte_vocabulary, word_vocabulary, monkeypatch):
    path = byte_vocabulary if which == "byte" else word_vocabulary
    t = Tokenizer.from_file(path)
    mine = Encoder(path)
    assert mine.split is not None

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from("abE é'sd1 \n\t,.\x01ß$日 "), max_size=40)))
    def check(some):
        got = [np.frombuffer(x, "<u4").tolist() for x in mine.encode_batch(some)]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in some]

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from("aZ's1 .ÀÿßŒŽžİıŉſĲȺ×÷\u0301\u0308"), max_size=30)))
    def check_latin(some):
        got = [np.frombuffer(x, "<u4").tolist() for x in mine.encode_batch(some)]
        assert got == [t.encode(x, add_special_tokens=False).ids for x in some]

    check()
    check_latin()
    got = [np.frombuffer(x, "<u4").tolist() for x in mine.encode_batch(ODD)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in ODD]
    monkeypatch.setattr("stockweave.llm.tokens.KEPT_WORDS", 3)  # forgets all the time
    again = [np.frombuffer(x, "<u4").tolist() for x in mine.encode_batch(ODD * 2)]
    assert again == got * 2


@pytest.mark.parametrize("which", ["byte", "word"])
def test_a_full_memory_keeps_the_first_words(which, byte_vocabulary, word_vocabulary, monkeypatch):
    monkeypatch.setattr("stockweave.llm.tokens.KEPT_WORDS", 1000)
    path = byte_vocabulary if which == "byte" else word_vocabulary
    mine, whole = Encoder(path), Tokenizer.from_file(path)

    def check(text, made):
        assert np.frombuffer(made, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    first = "abc dea bed"
    mine.encode_batch([first])
    for k in range(200):
        text = first + " " + " ".join(f"{k}abe{j}d,x{k * j}" for j in range(40))
        check(text, mine.encode_batch([text])[0])
        held = [x for x in vars(mine).values() if isinstance(x, dict)]
        assert sum(map(len, held)) < 2000  # words and pieces together
        assert set(mine.split.findall(first)) <= set(mine.words)
    many = f"{first} " + " ".join(f"ab{k}" for k in range(3000))  # more words than are kept
    check(many, mine.encode(many))


def test_sum_of_squares_follows_the_rule():
    def plain(lengths, capacity):
        gaps, where = [], []
        for size in lengths:
            best = None
            for gap in sorted({g for g in gaps if g >= size} | {capacity}):
                after = Counter(g for g in gaps if g)
                if gap != capacity or gap in gaps:
                    after[gap] -= 1
                if gap == capacity and capacity not in gaps:
                    pass
                if gap - size:
                    after[gap - size] += 1
                cost = sum(v * v for v in after.values())
                if best is None or cost < best[0]:
                    best = (cost, gap)
            gap = best[1]
            if gap == capacity:
                gaps.append(capacity - size)
                where.append(0)
            else:
                gaps.remove(gap)
                gaps.append(gap - size)
                where.append(capacity - gap)
        return sorted(gaps), where

    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(1, 20, 60)
        where, offset = packing.sum_of_squares(lengths, 20)
        gaps, offsets = plain(lengths.tolist(), 20)
        filled = np.bincount(where, weights=lengths).astype(int)
        assert sorted((20 - filled).tolist()) == gaps
        assert offset.tolist() == offsets


def check_packed(packed, capacity):
    for _, seq in packed.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"] == seq["length"].cumsum() - seq["length"]).all()
        assert seq["length"].sum() <= capacity


def test_packing_places_every_token_once(small_docs, byte_vocabulary):
    packed = packing.pack(small_docs, byte_vocabulary, capacity=512, shard_pieces=100).toPandas()
    check_packed(packed, 512)
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    mine = Encoder(byte_vocabulary)
    assert set(packed["doc_id"]) == set(texts)
    for doc, rows in packed.groupby("doc_id"):
        ids = np.append(np.frombuffer(mine.encode(texts[doc]), "<u4"), 0).astype("<u4")
        rows = rows.sort_values("piece")
        assert rows["piece"].tolist() == list(range(len(rows)))
        assert (rows["length"][1:] == 512).all() and rows["length"].sum() == len(ids)
        for r in rows.itertuples():
            part = ids[r.start : r.start + r.length]
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
    best = -(-packed["length"].sum() // 512)
    assert packed["sequence_id"].nunique() <= 1.03 * best + 1


def test_packing_edges(docs_of, byte_vocabulary):
    rows = [(1, None), (2, ""), (3, "word " * 300), (3, "word " * 300), (None, "x")]
    packed = packing.pack(docs_of(rows), byte_vocabulary, capacity=64, with_ids=True)
    got = packed.drop("ids").toPandas()
    check_packed(got, 64)
    assert got["doc_id"].isna().sum() == 1 and (got["doc_id"] == 3).sum() == 10
    joined = {r["sequence_id"]: r["n_tokens"] for r in packing.sequences(packed).collect()}
    assert joined == got.groupby("sequence_id")["length"].sum().to_dict()
    assert packing.pack(docs_of([]), byte_vocabulary).count() == 0


@pytest.mark.parametrize("together", [2, 4096])
def test_token_files_round_trip(spark, small_docs, word_vocabulary, tmp_path, monkeypatch, together):
    monkeypatch.setattr(tokenfiles, "PARTS_PER_GROUP", together)
    path = str(tmp_path / "files")
    tokenfiles.write(small_docs, path, word_vocabulary, end_id=1)
    got = tokenfiles.read(spark, path, with_ids=True).orderBy("doc_id").collect()
    at = 0
    mine = Encoder(word_vocabulary)
    rows = small_docs.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    for have, row in zip(got, rows, strict=True):
        ids = np.append(np.frombuffer(mine.encode(row["text"]), "<u4"), 1).astype("<u4")
        assert have["ids"] == ids.tolist()
        assert (have["start"], have["n_tokens"]) == (at, len(ids))
        assert have["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)
    # single documents are read by their offsets, and only with their own dictionary
    stored = spark.read.parquet(f"{path}/dictionary").first()
    block = spark.read.parquet(f"{path}/blocks").orderBy("part", "block").first()
    reader = tokenfiles.Block(bytes(block["payload"]), bytes(stored["dictionary"]), False)
    want = next(r for r in got if r["doc_id"] == block["doc_ids"][0])
    assert reader.document(0).tolist() == want["ids"]
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfiles.Block(bytes(block["payload"]), b"other", False)
    assert struct.unpack_from("<I", block["payload"], 4)[0] == block["documents"]


def test_token_files_edges(docs_of, word_vocabulary):
    rows = [(2, None), (1, ""), (5, "same text"), (5, "same text"), (None, "no name")]
    got = tokenfiles.token_table(docs_of(rows), word_vocabulary, 1).toPandas()
    assert got.sort_values("start")["n_tokens"].tolist() == [3, 1, 1, 3, 3]
    assert tokenfiles.token_table(docs_of([]), word_vocabulary, 1).count() == 0
