"""Operators on texts against plain versions, on awkward rows, and on empty tables."""

import re
from collections import Counter

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_cases import awkward, base_spans, empty, line_dedup, near_classes, probability_jaccard, repeats, sha, texts, window_dedup, words

from chartmart.llm import bpe, linededup, probminhash, quality, secret_ledger, substring, toxicity
from chartmart.llm import text as T
from chartmart.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def key(rows):
    return sorted(map(tuple, rows), key=str)


def test_words_and_hashes():
    given = [t for _, t in texts()]
    w = T.words_of(pa.array(given))
    got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [words(t) for t in given]
    name = {}
    for h, s, e in zip(w.hashes(), w.start, w.end):
        assert name.setdefault(int(h), bytes(w.data[s:e])) == bytes(w.data[s:e])
    assert len(T.words_of(pa.array([], pa.string())).row) == 0


def test_substring_dedup(spark):
    got = substring.dedup(awkward(spark), sketch_bits=1 << 20, group_bytes=1 << 16).collect()
    assert key(got) == key(window_dedup(texts(), 20))
    assert substring.dedup(empty(spark)).collect() == []


def test_substring_dedup_loses_nothing_with_a_full_sketch(spark, monkeypatch):
    monkeypatch.setattr(substring, "_RANGE", 256)
    monkeypatch.setattr(substring, "_sketch", lambda texts, size, gram, cells: np.full((substring.DEPTH, cells // 8), 255, np.uint8))
    assert key(substring.dedup(awkward(spark)).collect()) == key(window_dedup(texts(), 20))


def test_line_dedup(spark):
    got = linededup.cut(awkward(spark), group_bytes=1 << 16).select("row.doc_id", "n_lines", "n_removed", "row.text").collect()
    expected = [(i, n, gone, t) for i, n, gone, t in line_dedup(texts(), 2, 20)]
    # rows equal in id and text have equal results; a null text stays null
    assert key(got) == key(expected)
    row = linededup.cut(awkward(spark)).select("row.*")
    assert row.columns == awkward(spark).columns
    assert linededup.cut(empty(spark)).collect() == []


def test_line_dedup_longer_runs(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "b\nc\nq"), (4, "c\nd\nb\nc\nd")]
    got = linededup.cut(awkward(spark, rows), run=3, gram=2, alone=50).select("row.doc_id", "n_lines", "n_removed", "row.text").collect()
    assert key(got) == key(line_dedup(rows, 3, 50))


@pytest.mark.parametrize("run, gram", [(2, 1), (3, 1), (4, 2), (2, 2)])
@pytest.mark.parametrize("group_bytes", [64, 1 << 20])  # many groups, where most lines are heavy, and few, where hardly one is
def test_winnowing_loses_no_run(spark, run, gram, group_bytes):
    rng = np.random.default_rng(run * 10 + gram)
    rows = [(k, "\n".join(f"line {x}" if x else " " for x in np.minimum(rng.zipf(1.3, rng.integers(0, 30)) - 1, 40))) for k in range(150)]
    got = linededup.cut(awkward(spark, rows), run=run, gram=gram, alone=50, group_bytes=group_bytes)
    assert key(got.select("row.doc_id", "n_lines", "n_removed", "row.text").collect()) == key(line_dedup(rows, run, 50))


def test_winnowing_selects_window_minima():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    given = ["\n".join(f"v{x}" for x in rng.integers(0, 9, n)) for n in (0, 1, 3, 4, 40, 200)]
    lines = linededup._Lines(pa.array(given))
    for run, gram in ((2, 1), (4, 1), (5, 3), (3, 3)):
        hashes = [int(linededup.T.runs_hash(lines.h1, np.array([i]), np.array([i + gram]), 1)[0]) for i in range(len(lines.row) - gram + 1)]
        expected = set()
        for s in range(len(lines.row) - run + 1):
            if lines.row[s] == lines.row[s + run - 1]:
                own = range(s, s + run - gram + 1)
                expected |= {i for i in own if hashes[i] == min(hashes[j] for j in own)}
        assert linededup.selected(lines, run, gram)[0].tolist() == sorted(expected)


def near_rows():
    rng = np.random.default_rng(3)
    base = [f"v{x}" for x in rng.integers(0, 5000, 150)]
    rows = list(texts())
    for k in range(40):  # a group of copies with edits of their own
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            own[at] = f"e{rng.integers(0, 10**6)}"
        rows.append((100 + k, " ".join(own)))
    return rows


def test_near_dedup(spark):
    rows = near_rows()
    got = probminhash.dedup(awkward(spark, rows), block=16).collect()  # blocks smaller than the group
    assert len(got) == len(rows)
    expected = near_classes(rows)
    for r in got:
        assert r.class_id == (expected.get(r.doc_id, r.doc_id)), r
        assert r.kept == (r.doc_id is None or r.class_id == r.doc_id)
    assert probminhash.dedup(empty(spark)).collect() == []


def test_registers_agree_with_the_similarity():
    rng = np.random.default_rng(1)
    for _ in range(3):
        a, b = (Counter({int(k): int(v) for k, v in zip(rng.integers(1, 40, 30), rng.integers(1, 6, 30))}) for _ in range(2))
        arrays = [(np.array(sorted(c), dtype=np.uint64), np.array([c[k] for k in sorted(c)], dtype=np.float64)) for c in (a, b)]
        exact = probability_jaccard(a, b)
        assert probminhash.probability_jaccard(*arrays[0], *arrays[1]) == pytest.approx(exact)
        sig = probminhash.signatures(np.repeat([0, 1], [len(a), len(b)]), T.mix(np.concatenate([x for x, _ in arrays])), np.concatenate([c for _, c in arrays]), 2, 4096)
        assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.05)


def test_quality_counts_copies_and_repeated_ids_as_one_trial(spark):
    text = " ".join(f"w{i}" for i in range(60))
    bad = [(1000 + k, " ".join(f"v{k}x{i}" for i in range(60)) + " ####" * 30) for k in range(100)]
    schema = "doc_id long, text string, lang string"
    copies = spark.createDataFrame([(i, t, "en") for i, t in [(k, text) for k in range(600)] + bad], schema)
    same_id = spark.createDataFrame([(0, f"{text} {k}", "en") for k in range(600)] + [(i, t, "en") for i, t in bad], schema)
    labels = spark.createDataFrame([(i, 1) for i in range(600)] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    for docs in (copies, same_id):  # one good trial, in 600 rows: nothing is certified
        assert quality.cutoffs(quality.counts(docs), labels, risk=0.05).collect() == []
        assert all(r.kept for r in quality.judge(docs, labels, risk=0.05).collect())
    awkward_labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1), (99, 0)], "doc_id long, quality int")
    got = quality.judge(awkward(spark), awkward_labels).collect()
    assert len(got) == awkward(spark).count() and not any(r.kept for r in got if r._q.n_words < 50)


def test_quality_counts(spark):
    rows = texts() + [(20, "a b c a b c d"), (21, "# a ** $b\nx\nx\n\nx y"), (22, "a b c d")]
    got = quality.counts(awkward(spark, rows)).select("row.text", "_q.*").collect()
    for r in got:
        w = words(r.text)
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeats(r.text)


def test_quality_cutoffs_keep_the_risk(spark):
    import math

    good = [(k, " ".join(f"w{k}x{i}" for i in range(60)) + " #" * (k % 3)) for k in range(600)]
    bad = [(1000 + k, " ".join(f"v{k}x{i}" for i in range(60)) + " ####" * 30) for k in range(100)]
    docs = spark.createDataFrame([(i, t, "en", 0) for i, t in good + bad] + [(5000, good[0][1], None, 1)], "doc_id long, text string, lang string, row int")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(99999, 1), (1, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels, risk=0.05).select("row.doc_id", "kept").collect()}
    assert all(got[i] for i, _ in good) and not any(got[i] for i, _ in bad) and got[5000]
    assert quality.keep(docs, labels, risk=0.05).columns == docs.columns
    counted = quality.counts(docs)
    cut = quality.cutoffs(counted, labels, risk=0.05).collect()
    # 600 good documents, none over: (1 - risk / 4) ** 600 is within the corrected doubt
    assert (1 - 0.05 / 4) ** 600 <= 0.05 / 4 and {r["_stratum"] for r in cut} == {"en"} and cut[0]["_cut_symbols"] < 100
    few = quality.cutoffs(counted, labels.where("doc_id < 50 or doc_id >= 1000"), risk=0.05).collect()
    assert few == []  # too few labels certify nothing
    assert quality.judge(empty(spark), labels).collect() == []
    n, k, p = 700, 9, 0.02
    exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    from pyspark.sql import functions as F

    from chartmart.llm.sqlmath import binomial_tail

    assert spark.range(1).select(binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")).first()["x"] == pytest.approx(exact, rel=1e-9)


def test_secret_ledger(spark):
    docs = awkward(spark)
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "ledger-test"))
    ledger.scan(docs)
    got = ledger.findings(docs)
    names = set(secret_ledger.BASE)
    by_blob = {sha(t or ""): base_spans(t) for _, t in texts()}
    rows = got.select("blob", "spans").collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] in names) == by_blob[r["blob"]]
    # a second scan finds nothing unseen; a new rule version scans every blob for that rule only
    ledger.scan(docs)
    n = spark.read.option("recursiveFileLookup", "true").schema(ledger.SCHEMA).parquet(ledger.folder).count()
    assert n == len(by_blob)
    newer = tuple(r._replace(version=2, pattern="AKIA[A-Z0-9]{3}", least=0) if r.name == "access" else r for r in secret_ledger.RULES)
    ledger.scan(docs, rules=newer)
    parts = spark.read.option("recursiveFileLookup", "true").schema(ledger.SCHEMA).parquet(ledger.folder)
    assert parts.where("size(scans) = 1 and scans[0].rule = 'access' and scans[0].version = 2").count() == len(by_blob)
    spans = [s for r in ledger.findings(docs, rules=newer).collect() for s in r["spans"] if s["kind"] == "access"]
    assert [s["end"] - s["start"] for s in spans] == [7]
    # history: another version of a path with a known blob costs no scan
    more = docs.union(docs.limit(1))
    ledger.scan(more, rules=newer)
    assert spark.read.option("recursiveFileLookup", "true").schema(ledger.SCHEMA).parquet(ledger.folder).count() == 2 * len(by_blob)
    with pytest.raises(Exception):
        secret_ledger.Ledger(spark, "nosuchscheme://x/y").entries()
    fresh = secret_ledger.Ledger(spark, scratch_path(spark, "ledger-empty"))
    fresh.scan(empty(spark))
    assert fresh.findings(empty(spark)).collect() == []


def tokenizer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark):
    given = texts() + [(30, "a" * 700 + "<|endoftext|>"), (31, "\n\n  don't 123456789 ßtraße"), (32, "ababab" * 40)]
    enc = tokenizer()
    docs = awkward(spark, given)
    rows = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, ["doc_id", "kept"])
    got = rows.collect()
    assert key([(r.doc_id, r.ids) for r in got]) == key([(i, enc.encode_ordinary(t or "")) for i, t in given])
    back = bpe.decode(rows, RANKS, ["doc_id"]).collect()
    assert key([(r.doc_id, bytes(r["bytes"]).decode()) for r in back]) == key([(i, t or "") for i, t in given])
    digest = bpe.digest(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert key(digest) == key([(i, len(x), sha(",".join(map(str, x))), sha(t or "")) for i, t in given for x in [enc.encode_ordinary(t or "")]])
    assert bpe.digest(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [99999999])], "doc_id long, ids array<int>"), RANKS, ["doc_id"]).collect()


def test_bpe_any_row_order():
    """The recursion orders its rows itself: bytes given in any order, long unbroken pieces too, encode alike."""
    rng = np.random.default_rng(11)
    enc = tokenizer()
    ranks = bpe.read_ranks(None, RANKS)
    codec = bpe.Codec(ranks, bpe.merge_table(ranks))
    pieces = ["".join(rng.choice(list("abcdeinorst"), n)).encode() for n in (1, 2, 3, 7, 40, 300, 2500)] + [b"aaaaaaa", "ßüé中".encode(), b"a" * 2500]
    expected = [enc._encode_single_piece(p) for p in pieces]
    assert codec.encode(pieces).to_pylist() == expected
    rows = [(i, k, int(codec.byte[b])) for i, p in enumerate(pieces) for k, b in enumerate(p)]
    for _ in range(3):
        piece, pos, token = (np.array(x, dtype=np.int32) for x in zip(*(rows[j] for j in rng.permutation(len(rows)))))
        found = codec._ask(bpe._ENCODE, "bytes", pa.table({"piece": piece, "pos": pos, "token": token}))
        assert found.column("ids").to_pylist() == expected


def test_bpe_remembers_a_bounded_number_of_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN", 5)
    enc = tokenizer()
    ranks = bpe.read_ranks(None, RANKS)
    known = bpe._Known(bpe.Codec(ranks, bpe.merge_table(ranks)), bpe._Digest)
    asked = []
    encode = known.codec.encode
    monkeypatch.setattr(known.codec, "encode", lambda pieces: asked.extend(pieces) or encode(pieces))
    for k in range(12):
        own = [" common", "ß中", *(f"word{k}x{j}" for j in range(3))] + ["word0x0"] * (k == 11)
        listed, back = known.of(own + own)
        assert [listed[p] for p in own] == [",".join(map(str, enc.encode_ordinary(p))) for p in own]
        assert [back[p] for p in own] == own and all(back[p] is p for p in back)
        assert sum(map(len, (*known.young, *known.old))) <= 2 * 2 * (5 + len(own))
    assert asked.count(b" common") == 1 and asked.count(b"word0x0") == 2  # in use: kept; not met again: dropped


def test_a_worker_keeps_its_pieces_for_the_next_partition(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    other = {bytes([b]): 255 - b for b in range(256)}
    asked = []
    real = bpe._Digest.memo
    monkeypatch.setattr(bpe._Digest, "memo", staticmethod(lambda pieces, codec: asked.append(pieces) or real(pieces, codec)))
    monkeypatch.setattr(bpe._Known, "_left", {})

    def partition(table, pieces):
        known = bpe._Known(bpe.Codec(table, bpe.merge_table(table)), bpe._Digest, bpe._digest_of(table))
        listed, back = known.of(pieces)
        out = [listed[p] for p in pieces], [back[p] for p in pieces]
        known.leave()
        return out

    first = partition(ranks, ["abc", "ab", "x"])
    assert first == (["257", "256", "120"], ["abc", "ab", "x"])
    assert partition(ranks, ["x", "abc", "y"]) == (["120", "257", "121"], ["x", "abc", "y"])
    assert asked == [["abc", "ab", "x"], ["y"]]
    assert partition(other, ["x"]) == (["135"], ["x"]), "another tokenizer has ids of its own"
    assert asked[-1] == ["x"] and len(bpe._Known._left) == 1


def test_bpe_gets_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, then in (("10000", "1000"), ("0", "1000"), ("200", "200")):
            spark.conf.set(name, given)
            assert bpe.digest(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
            assert spark.conf.get(name) == then
    finally:
        spark.conf.set(name, before)


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    vocabulary = [a + b + c for a in ("ther", "ing", "and", "ons", "ble") for b in ("re", "at", "is", "ou") for c in ("st", "nd", "er", "ly")]
    bad = ("idiot", "moron", "stupid", "loser")
    twisted = {"idiot": "1d!0t", "moron": "m o r o n", "stupid": "stuuupid", "loser": "l0$er"}
    rows, labels = [], []
    for i in range(1200):
        text = [str(x) for x in rng.choice(vocabulary, 40)]
        toxic = i % 6 == 0
        if toxic:
            word = bad[i // 6 % 4]
            text.insert(int(rng.integers(0, 40)), twisted[word] if i % 12 == 0 else word)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += texts()[2:5] + [(None, "idiot"), (77777, "an 1d10t"), (77777, "an 1d10t")]
    label = spark.createDataFrame([*labels, (None, 1), (88888, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity.score(awkward(spark, rows), label).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    want = dict(labels)
    held = [(r.predicted, want[r.doc_id]) for r in got if r.held_out and r.doc_id in want and r.doc_id < 1200 and r.doc_id not in (2, 3, 4)]
    assert len(held) > 150 and sum(p == y for p, y in held) / len(held) > 0.97
    assert all(r.predicted == 1 for r in got if r.doc_id == 77777)
    assert toxicity.score(empty(spark), label).collect() == []
    none = toxicity.score(awkward(spark, rows[:3]), label.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 3


def test_restorer_reads_the_lattice():
    words_ = "the idiot and the clown are worthless and pathetic while moron and loser think".split() * 50
    signs = toxicity._signs(" " + " ".join(words_) + " ")
    n = np.bincount((signs[:-2] * 28 + signs[1:-1]) * 28 + signs[2:], minlength=28**3)

    class Counts:
        def collect(self):
            return [{"at": k, "n": float(v)} for k, v in enumerate(n) if v]

    read = toxicity.Restorer(toxicity.model(Counts()))
    for given, word in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("iiidiot", "idiot"), ("cl0wn!!", "clown"), ("w0rthl3ss", "worthless"), ("m.o.r.o.n", "moron"), ("l*ser", "loser")):
        assert word in read.words(f"so {given} yes"), given
    assert read.words("plain words, here.") == {"plain", "words", "here"}


def test_restorer_decodes_what_differs_once():
    made = []

    class Counted(toxicity.Restorer):
        def decode(self, given):
            made.append(given)
            return super().decode(given)

    read = Counted(np.zeros((28, 28, 28)))
    text = "balloon balloon, 'balloon' balloon. I d i o t a b sad a b c"
    assert read.words(text) >= {"balloon", "sad"}
    assert sorted(made) == ["a b c", "balloon", "i d i o t a b"]
    assert list(toxicity._spaced("a b cc d e f gg h i".split())) == ["d e f"]


def test_restorer_reads_long_lattices_whole():
    words_ = "you are an idiot and the moron so very much of all people here".split()
    signs = toxicity._signs(" " + " ".join(words_ * 50) + " ")
    n = np.bincount((signs[:-2] * 28 + signs[1:-1]) * 28 + signs[2:], minlength=28**3)

    class Counts:
        def collect(self):
            return [{"at": k, "n": float(v)} for k, v in enumerate(n) if v]

    read = toxicity.Restorer(toxicity.model(Counts()))
    for shift in range(24):  # a word at every place
        for gap in (" ", "\t"):
            assert "idiot" in read.words(gap.join("the" * shift + "idiot" + "the" * 12)), shift
    for gap in ("  ", "\n", "\u00a0", " \r\n "):
        assert "idiot" in read.words(gap.join("idiot")), gap
    assert {"idiot", "moron"} <= read.words(f"an {'i' * 90}diot and m0r{'o' * 200}n")
    assert read.decode("m0r" + "o" * 500 + "n") == "moron"
    long = read.decode("1d10t " * 50_000)  # a cost in proportion
    assert len(long) >= 250_000 and long.split()[0] == long.split()[-1] == "idiot"


def test_line_dedup_spreads_a_common_line(spark, monkeypatch):
    import pyarrow as pa

    # the common line with the least hash of many, the fingerprint of every document, between neighbours that differ
    hot = min((f"common line {k}" for k in range(2000)), key=lambda x: linededup.selected(linededup._Lines(pa.array([x])), 1, 1)[1][0])
    rows = [(n, f"before {n}\n{hot}\nafter {n}") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(linededup, "_joined", lambda sent, run, gram: sent)
    sent = linededup.later_lines(linededup.T.keyed(docs, "doc_id", "text")).collect()
    parts = {}
    for r in sent:
        parts[r.part] = parts.get(r.part, 0) + len(r.ids) // 8
    assert sum(parts.values()) == 800 and max(parts.values()) < 200


def test_ledger_counts_a_scan_that_was_run_twice_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "password=abcdefghijklmno"), (2, "nothing")], "doc_id long, text string")
    ledger = secret_ledger.Ledger(spark, f"{tmp_path}/ledger")
    ledger.scan(docs)
    [part] = [p for p in (tmp_path / "ledger").iterdir() if p.is_dir()]
    spark.read.schema(ledger.SCHEMA).parquet(str(part)).write.parquet(f"{tmp_path}/ledger/part-of-another-job")
    found = {r.row.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in ledger.findings(docs).collect()}
    assert found[1] == sorted(set(found[1])) and len([s for s in found[1] if s[0] == "assign"]) == 1 and found[2] == []
