import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.llm import langid, linededup, mixing, pseudolm, quality
from stockweave.llm.quality import suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(5)
    for _ in range(60):
        text = rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint64)
        text[-1] = 9  # unlike all others
        order, common = suffix_array(text)
        t = text.tolist()
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        for k in range(1, len(t)):
            a, b = t[order[k - 1] :], t[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == n


def plain_quality(text, least=quality.MIN_REPEAT_WORDS):
    words = WORD.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)

    def covered(n):
        counts = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        out = set()
        for i in range(len(words) - n + 1):
            if counts[tuple(words[i : i + n])] > 1:
                out.update(range(i, i + n))
        return out

    longest = 0
    while covered(longest + 1):
        longest += 1
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        again,
        len(covered(3)),
        len(covered(least)),
        longest if longest >= least else 0,
    )


def test_quality_counts_match_brute_force(docs_of):
    rng = np.random.default_rng(1)
    rows = [(0, None), (1, ""), (2, "\n \t\n"), (3, "é\x85ü # $$ <b> " * 40), (3, "again " * 9)]
    for k in range(4, 40):
        words = rng.choice(["a", "bb", "ccc", "d", "ee"], rng.integers(1, 120))
        rows.append((k, "".join(w + rng.choice([" ", "\n", "  "]) for w in words)))
    got = quality.rules(docs_of(rows), with_spans=True).collect()
    names = list(quality._COUNTS)
    want = collections.Counter((i, plain_quality(t)) for i, t in rows)
    assert collections.Counter((r["doc_id"], tuple(r[n] for n in names)) for r in got) == want
    for r in got:
        words, again = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (words < 50 or 100 * again > 50 * words)
        assert not (r["kept"] and r["base_failed"])


def test_quality_spans_and_verdict(docs_of):
    passage = " ".join(f"w{i}" for i in range(120))
    plain = " ".join(f"x{i}" for i in range(400))
    rows = [(1, f"{plain} {passage} middle {passage}"), (2, f"{plain} {passage}")]
    got = {r["doc_id"]: r for r in quality.rules(docs_of(rows), with_spans=True).collect()}
    assert (got[1]["kept"], got[2]["kept"]) == (False, True)  # the repeat is too long
    text = rows[0][1].encode()
    assert [text[s["start"] : s["end"]].decode() for s in got[1]["repeat_spans"]] == [passage] * 2
    kept = quality.filter_documents(docs_of(rows))
    assert kept.columns == docs_of([]).columns and [r["doc_id"] for r in kept.collect()] == [2]
    assert quality.rules(docs_of([])).count() == 0


def test_filter_keeps_columns_of_any_name(spark):
    text = " ".join(f"x{i}" for i in range(60))
    df = spark.createDataFrame(
        [(1, text, 5, None, [1.5])], "doc_id long, text string, kept int, row string, n_words array<double>"
    )
    assert quality.filter_documents(df).collect() == df.collect()


def plain_lines(rows):
    places = {}
    windows = {}
    for doc, text in rows:
        lines = [(i, x) for i, x in enumerate((text or "").split("\n")) if WORD.search(x)]
        windows[doc] = [
            (tuple(x for _, x in lines[k : k + 3]), lines[k][0], lines[k + 2][0])
            for k in range(len(lines) - 2)
        ]
        for content, at, _ in windows[doc]:
            places.setdefault(content, []).append((doc, at))
    out = {}
    for doc, text in rows:
        gone = set()
        for content, at, last in windows[doc]:
            if (doc, at) > min(places[content]):
                gone.update(range(at, last + 1))
        lines = (text or "").split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[doc] = (None if text is None else kept, len(gone))
    return out


def test_line_windows_match_brute_force(docs_of):
    rng = np.random.default_rng(2)
    rows = [(0, None), (1, ""), (2, "one\ntwo"), (3, "a\nb\nc"), (4, "a\n\nb\nc\nd"), (5, "a\na\na\na\na")]
    for k in range(6, 60):
        lines = rng.choice(["a", "b", "c", "", " ", "d e"], rng.integers(1, 15))
        rows.append((k, "\n".join(lines)))
    got = linededup.dedup_lines(docs_of(rows)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got} == plain_lines(rows)


def test_line_windows_edges(docs_of):
    twins = docs_of([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc"), (None, "a\nb\nc")])
    got = linededup.dedup_lines(twins).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, 3), (1, 3), (2, 3)]
    assert linededup.dedup_lines(docs_of([])).count() == 0
    clean = linededup.clean_documents(docs_of([(1, "a\nb\nc\nx"), (2, "a\nb\nc"), (3, "a\nb\nc\ny")]))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()) == [
        (1, "a\nb\nc\nx", 7),
        (3, "y", 1),
    ]


def test_language_is_found_in_held_out_texts(small_docs):
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    got = langid.identify(small_docs, held).join(small_docs.select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert len(rows) == small_docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.97 * len(test)


def test_n_grams_match_brute_force():
    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        counts = collections.Counter()
        for w in words:
            padded = f"\x01{w}\x01"
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    counts[padded[i : i + n]] += 1
        del counts["\x01"]
        return counts

    for text in ["The the, then!", "a", " ", "", "İß 日本 x1y ÉÉ", "aa aa  bb\ncc-dd"]:
        codes, times = langid._grams(text)
        got = {}
        for code, n in zip(codes.tolist(), times.tolist(), strict=True):
            chars = [(code >> s) & langid._MASK for s in (42, 21, 0)]
            got["".join(chr(c) for c in chars if c)] = n
        assert got == {k: v for k, v in plain(text).items() if v}


def test_language_edges(docs_of):
    none = docs_of([(1, None), (2, "12 !!"), (3, "words here")], lang=None)
    got = langid.identify(none, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    some = docs_of([(1, None), (2, ""), (3, "words here"), (3, "words here")])
    got = langid.identify(some, F.lit(False)).collect()
    assert sorted(r["lang_pred"] for r in got) == ["en", "en", "und", "und"]
    assert langid.identify(docs_of([]), F.lit(False)).count() == 0


def test_raking_meets_all_targets(small_docs):
    targets = {"lang": {"en": 1, "fr": 1, "de": 1, "es": 1}}
    cells = mixing.raked_cells(mixing.celled(small_docs), targets, rounds=16).toPandas()
    total = cells["weight"].sum()
    assert total == pytest.approx(1)
    shares = cells.groupby("lang")["weight"].sum()
    assert shares.to_dict() == pytest.approx(dict.fromkeys("en fr de es".split(), 0.25), abs=1e-3)
    tokens = cells.groupby("source")["tokens"].sum() ** mixing.TEMPER
    want = (tokens / tokens.sum()).to_dict()
    assert cells.groupby("source")["weight"].sum().to_dict() == pytest.approx(want, abs=1e-3)


def test_mixture_keeps_the_share(small_docs):
    got = mixing.mix(small_docs, share=0.5).drop("row").toPandas()
    assert len(got) == small_docs.count()
    expected = (got["n_tokens"] * got["probability"]).sum() / got["n_tokens"].sum()
    assert expected == pytest.approx(0.5, abs=0.02)


def test_a_cell_without_more_tokens_is_made_up_for(spark):
    have = {("A", "en"): 60, ("A", "de"): 5, ("B", "en"): 10, ("B", "de"): 25}
    rows = [(i, "w " * n, s, lang) for i, ((s, lang), n) in enumerate(have.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    even = {"source": {"A": 1, "B": 1}, "lang": {"en": 1, "de": 1}}
    # without caps B-de would get 25.4 of its 25; the only other way to 30 each is 25, 5, 5, 25
    made = mixing.raked_cells(mixing.celled(docs), even, rounds=40, share=0.6)
    cells = mixing.calibrated(made, 0.6)
    got = {(r["source"], r["lang"]): r["probability"] * r["tokens"] for r in cells.collect()}
    want = {("A", "en"): 25, ("A", "de"): 5, ("B", "en"): 5, ("B", "de"): 25}
    assert got == pytest.approx(want, abs=0.3)
    for r in mixing.reached(cells).collect():
        assert r["expected"] == pytest.approx(r["wanted"], abs=0.01)
    # a target beyond a group's tokens is told: 60 tokens of A are drawn of 65, so B gives all of 35
    most = {"source": {"B": 1, "A": 0.1}, "lang": {"en": 1, "de": 1}}
    cells = mixing.calibrated(mixing.raked_cells(mixing.celled(docs), most, share=0.6), 0.6)
    told = {r["name"]: r for r in mixing.reached(cells).filter("key = 'source'").collect()}
    assert told["B"]["wanted"] == pytest.approx(1 / 1.1)
    assert told["B"]["expected"] == pytest.approx(35 / 60, abs=0.01)


def test_mixture_edges(docs_of):
    rows = docs_of([(1, None), (2, ""), (None, "some words"), (4, "more words"), (4, "more words")])
    got = mixing.mix(rows.withColumn("source", F.lit(None).cast("string"))).collect()
    assert len(got) == 5 and all(0 <= r["probability"] <= 1 for r in got)
    assert mixing.sample(rows).columns == rows.columns
    assert mixing.mix(docs_of([])).count() == 0


def test_mixture_runs_no_python(small_docs):
    plan = mixing.mix(small_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def vocabulary_of(rows, known=pseudolm.KNOWN):
    counts = pseudolm.word_counts(rows)
    return counts, pseudolm.Vocabulary(*pseudolm.split_counts(counts, known))


def test_word_counts_and_their_border_are_exact(small_docs):
    rows = small_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    want = collections.Counter(
        w for r in rows.collect() for w in re.findall(r"[^ \t-\r]+", r["text"].lower())
    )
    counts = pseudolm.word_counts(rows)
    assert sorted(r["n"] for r in counts.collect()) == sorted(want.values())
    words, n, totals = pseudolm.split_counts(counts, 500)
    assert 0 < len(words) <= 500
    assert sorted(n.tolist()) == sorted(want.values())[-len(n) :]
    assert n.sum() + totals.sum() == sum(want.values())


def test_network_gradient_matches_differences():
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    v = pseudolm.Vocabulary(
        words, rng.integers(1, 90, 300), rng.integers(0, 3, pseudolm.BUCKETS)
    )
    p = [x.astype(np.float64) for x in pseudolm.first_parameters(v)]
    p = [x + rng.normal(0, 0.1, x.shape) for x in p]
    windows = rng.integers(0, v.inputs, (30, 4)).astype(np.uint16)
    outputs = rng.integers(0, 300, 30)

    def loss(q):
        return -pseudolm.log_outputs(q, v, windows, outputs).mean()

    q = [x.copy() for x in p]
    pseudolm.train_batch(q, v, windows, outputs, 1.0, 1.0)
    _, forks, _ = v.paths(outputs)
    for k in range(7):
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        share = 1.0
        if k == 0:
            at = (int(windows[0, 0]), 3)
        if k > 4:  # a fork steps by the mean over the words that pass it
            fork = int(forks[5])
            at = (fork, 3) if k == 5 else (fork,)
            share = max((forks == fork).sum(), pseudolm.FORK_LEAST) / 30
        eps = 1e-5
        up = [x.copy() for x in p]
        up[k][at] += eps
        down = [x.copy() for x in p]
        down[k][at] -= eps
        slope = (loss(up) - loss(down)) / (2 * eps)
        assert (p[k][at] - q[k][at]) * share == pytest.approx(slope, rel=1e-3, abs=1e-6)


def test_probabilities_of_all_outputs_sum_to_one(small_docs):
    rows = small_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    _, v = vocabulary_of(rows, 300)
    p = pseudolm.train(rows, v)
    everything = np.arange(len(v.class_of))
    for window in ([1, 5, 9, 2], [v.border, v.border, 0, 3]):
        windows = np.tile(np.array(window, dtype=np.uint16), (len(everything), 1))
        logs = pseudolm.log_outputs(p, v, windows, everything)
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    start = pseudolm.first_parameters(v)  # untrained: the frequencies of the words
    n = pseudolm.split_counts(pseudolm.word_counts(rows), 300)
    total = n[1].sum() + (n[2] + pseudolm.UNSEEN).sum()
    logs = pseudolm.log_outputs(start, v, windows, everything)[: len(n[1])]
    assert logs == pytest.approx(np.log(n[1] / total), abs=1e-3)


def test_scores_match_one_word_at_a_time(small_docs):
    """A plain forward pass: counts by Counter, one word, one turn at a time."""
    rows = small_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.filter("text NOT RLIKE '[^\\\\x01-\\\\x7f]'")
    counted = collections.Counter(
        w for r in rows.collect() for w in re.findall(r"[^ \t-\r]+", r["text"].lower())
    )
    counts, v = vocabulary_of(rows, 400)
    p = [x.astype(float) for x in pseudolm.train(rows, v)]
    got = {r["doc_id"]: r for r in pseudolm.score(rows, counts, v, p).collect()}
    import pyarrow as pa

    number = {}
    for w in counted:
        h = int(pseudolm.word_hashes(pa.array([w]))[0][0])
        at = int(np.searchsorted(v.words, np.uint64(h)))
        known = at < len(v.words) and int(v.words[at]) == h
        number[w] = (at if known else len(v.words) + (h >> (64 - pseudolm.BUCKET_BITS)), known)
    in_bucket = collections.Counter()
    for w, (out, known) in number.items():
        if not known:
            in_bucket[out] += counted[w]
    assert len(got) > 20
    for r in rows.limit(4).collect():
        words = re.findall(r"[^ \t-\r]+", r["text"].lower())
        total = 0.0
        for i, w in enumerate(words):
            sides = []
            for j in (i - 2, i - 1, i + 1, i + 2):
                inside = 0 <= j < len(words)
                sides.extend(p[0][v.input_of[number[words[j]][0]] if inside else v.border])
            h = np.tanh(np.array(sides) @ p[1] + p[2])
            raw = np.exp(h @ p[3] + p[4])
            out, known = number[w]
            total += np.log(raw[v.class_of[out]] / raw.sum())
            for k in range(v.path_start[out], v.path_start[out] + v.depth[out]):
                fork, side = v.forks[k], v.sides[k]
                total += np.log(1 / (1 + np.exp(-side * (h @ p[5][fork] + p[6][fork]))))
            if not known:
                total += np.log(counted[w] / (in_bucket[out] + pseudolm.UNSEEN))
        assert got[r["doc_id"]]["log_prob"] == pytest.approx(total, rel=1e-3)
        assert got[r["doc_id"]]["n_words"] == len(words)


def test_a_word_of_like_frequency_in_its_place_scores_lower(docs_of):
    rng = np.random.default_rng(3)
    pairs = [("red", "apple"), ("blue", "whale"), ("old", "castle"), ("dry", "desert")]
    rows = []
    for k in range(400):
        said = [pairs[i] for i in rng.integers(0, 4, 100)]
        rows.append((k, " ".join(f"{a} {b}" for a, b in said)))
    docs = docs_of(rows).select("doc_id", "text").coalesce(1)
    counts, v = vocabulary_of(docs)
    p = pseudolm.train(docs, v, 1)
    test = docs_of([(1, "old castle red apple dry desert"), (2, "old castle red whale dry desert")])
    got = {r["doc_id"]: r["log_prob"] for r in pseudolm.score(test, counts, v, p).collect()}
    assert got[1] > got[2] + 1


def test_unseen_words_and_splits(docs_of):
    docs = docs_of([(k, "some words that are here again and again") for k in range(50)])
    counts, v = vocabulary_of(docs, 3)
    p = pseudolm.train(docs.select("doc_id", "text"), v)
    test = docs_of([(1, "some words that"), (2, "zzqx vvkw that"), (2, "zzqx vvkw that")])
    one = sorted(pseudolm.score(test.coalesce(1), counts, v, p).collect())
    assert one == sorted(pseudolm.score(test.repartition(5), counts, v, p).collect())
    assert [r["n_words"] for r in one] == [3, 3, 3]
    assert one[1] == one[2] and one[0]["log_prob"] > one[1]["log_prob"]


def test_likelihood_edges(docs_of):
    got = pseudolm.pseudo_likelihood(docs_of([(1, None), (2, ""), (3, "a b c")])).collect()
    assert {r["doc_id"]: r["n_words"] for r in got} == {1: 0, 2: 0, 3: 3}
    assert [r["mean_log_prob"] for r in got if r["n_words"] == 0] == [None, None]
    assert pseudolm.pseudo_likelihood(docs_of([])).count() == 0
