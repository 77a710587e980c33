"""Merkle manifest, phrases and language identification, against plain versions."""

import collections
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, empty, sentence, sha, texts
from pyspark.sql import functions as F

from chartmart.llm import langid, merkle, phrases


def levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + fan])) for k in range(0, len(out[-1]), fan)])
    return out


def siblings(tree, at, fan):
    out = []
    for level in tree[:-1]:
        a = at // fan * fan
        out.append(("".join(level[a:at]), "".join(level[at + 1 : a + fan])))
        at //= fan
    return out


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows, fan):
    """``rows``: fields, claimed fields, group, id."""
    made = collections.defaultdict(list)
    for own, other, group, i in rows:
        made[group].append(((i is not None, i or 0, leaf(own)), leaf(own), leaf(other), i))
    groups = sorted(made, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[1] for x in sorted(made[g])], fan) for g in groups}
    top = levels([trees[g][-1][0] for g in groups], fan)
    out = []
    for k, g in enumerate(groups):
        for at, (_, own, other, i) in enumerate(sorted(made[g])):
            path = siblings(trees[g], at, fan) + siblings(top, k, fan)
            node = other
            for a, b in path:
                node = sha(a + node + b)
            out.append((i, own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("fan,height", [(2, 1), (2, 3), (3, 2), (2, 8)])
def test_merkle(spark, fan, height):
    given = awkward(spark, texts() + [(k, f"text {k}") for k in range(100, 140)])
    given = given.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source")))
    given = given.withColumn("n_chars", F.when(F.col("doc_id") % 5 > 0, F.length("text")).cast("long"))
    hit = F.coalesce(F.col("doc_id") % 7 == 3, F.lit(False))
    found = merkle.manifest(given, claimed={"n_chars": F.col("n_chars") + F.when(hit, 1).otherwise(0)}, fan=fan, height=height)
    folded = merkle.fold(F.col("claimed_leaf"), F.col("path"))
    got = found.select("id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), folded.alias("folded"), (folded == F.col("root")).alias("ok"))
    rows = [((r.doc_id, r.source, r.lang, r.n_chars, r.text), (r.doc_id, r.source, r.lang, r.n_chars if r.n_chars is None else r.n_chars + h, r.text), r.lang, r.doc_id)
            for r, h in [(x, x.doc_id is not None and x.doc_id % 7 == 3) for x in given.collect()]]
    assert key(tuple(r) for r in got.collect()) == key(plain_manifest(rows, fan))


def test_merkle_small_tables(spark):
    assert merkle.manifest(empty(spark)).collect() == []
    [one] = merkle.manifest(awkward(spark, [(5, "only")])).collect()
    assert one.leaf == one.subroot == one.root and one.path == []
    given = awkward(spark, [(4, "a"), (4, "a"), (4, "b")]).withColumn("lang", F.lit(None).cast("string"))
    got = merkle.manifest(given, fields=("doc_id", "text")).collect()
    a, b = leaf((4, "a")), leaf((4, "b"))
    tree = levels(sorted([a, a, b]), 2)
    assert {r.root for r in got} == {tree[-1][0]} and sorted(r.leaf for r in got) == tree[0]


def plain_pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split("[.,;:!?\x0a-\x0d]", text) if (w := re.findall("[^ \t]+", p))]


def plain_phrases(rows, least, most, top, cover=80, scale=2_000_000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for w in plain_pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        scored = []
        for p, a in found.items():
            if p not in longer or 100 * longer[p] < cover * a:
                s, k = min((scale * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, l, q, n[lang], -s) for r, (s, a, p, l, q) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(3)
    rows = [("en", " ".join(rng.choice(["The", "a", "b", "é", "日本", "New", "York"], 60)) + ". " + "hot topic " * 8) for _ in range(30)]
    return rows + [("de", "x " * 500), ("de", "New York, new york; NEW\tYORK\vnew york"), (None, "one two three"), ("und", "one  two three!"), ("en", None), ("en", ""),
                   ("fr", " \t\n.,"), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("least,most,period,bits", [(2, 4, 3, 27), (4, 4, 24, 15), (3, 3, 1, 15), (2, 2, 5, 20)])
def test_phrases(spark, least, most, period, bits):
    rows = phrase_rows()
    given = spark.createDataFrame([(x, t, "c", 1) for x, t in rows], "lang string, text string, phrase string, n int")
    got = phrases.collocations(given, least=least, most=most, top=40, period=period, filter_bits=bits)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, least, most, 40)


def test_phrase_parse(spark):
    """Own words make up the texts, and equal passages meet in the dictionary wherever they stand."""
    passage = sentence(1, 400)
    rows = [("en", sentence(k, 7) + " " + passage + " " + sentence(k + 50, 9)) for k in range(20)] + [("en", sentence(99, 30000))]
    chunks = phrases.dictionary(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert sum(r.own * r.weight for r in chunks) == sum(len(t.split()) for _, t in rows)
    assert sum(r.own for r in chunks if r.weight >= 20) > 300
    assert phrases.collocations(empty(spark)).collect() == []
    assert phrases.collocations(awkward(spark), least=1000).collect() == []
    row, own, chunk = phrases._chunks(phrases.Pieces(pa.array(["Aa bb. CC dd\n\nee", None, "", "F"])), 3, 10**9)
    assert (row.tolist(), own.tolist(), chunk) == ([0, 3], [5, 1], [b"aa bb\ncc dd\nee", b"f"])


def plain_grams(text):
    code = [c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()]
    words = "".join(code).split(" ")
    if not any(unicodedata.category(c)[0] == "L" for c in code):
        return collections.Counter()
    out = collections.Counter()
    for w in words:
        for n in range(1, 4):
            own = f"\1{w}\1" if w else ""
            out.update(g for i in range(len(own) - n + 1) if (g := own[i : i + n]).strip("\1"))
    # the border between two words is one sign, and belongs to both
    return out


def plain_rank(counts, top):
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - k)) for k, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:top]


def plain_lang(rows, scored, top):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        if lang is not None and text is not None:
            counts[lang] += plain_grams(text)
    known = {g: {x: k for k, x in enumerate(plain_rank(c, top))} for g, c in counts.items() if c}
    out = []
    for text in scored:
        own = plain_rank(plain_grams(text), top)
        if not own or not known:
            out.append(("und", 0.0))
            continue
        off, lang = min((sum(abs(p[g] - k) if g in p else top for k, g in enumerate(own)), x.encode()) for x, p in known.items())
        out.append((lang.decode(), 1 - off / (len(own) * top)))
    return out


@pytest.mark.parametrize("top,languages", [(30, 256), (400, 1), (400, 2)])
def test_langid(spark, top, languages):
    learn = [("en", "The cat and the hat. It's on THE mat, ét́"), ("fr", "Le chat et le chapeau, où est-il? Ça va"), ("ja", "日本語 の テキスト"), (None, "lost"),
             ("en", None), ("xx", "123 456"), ("fr", sentence(3, 3000)), ("ab", "same"), ("aa", "same")]
    score = [t for _, t in texts()] + [t for _, t in learn] + ["", "42 !?", "same", "the", "İstanbul ǅ", "́", "áb", "日本"]
    given = spark.createDataFrame([(k, x, t, "q") for k, (x, t) in enumerate(learn)], "n long, lang string, text string, gram string")
    learned = langid.profiles(given, top=top)
    frame = spark.createDataFrame(list(enumerate(score)), "id long, text string").withColumn("score_", F.lit(1))
    got = langid.predict(frame, learned, top=top, languages=languages).orderBy("id").collect()
    want = plain_lang(learn, score, top)
    assert [r.lang_pred for r in got] == [x for x, _ in want]
    assert np.allclose([r.score for r in got], [s for _, s in want]) and all(0 <= r.score <= 1 for r in got)


def test_langid_without_rows(spark):
    learned = langid.profiles(empty(spark))
    assert learned.collect() == [] and langid.predict(empty(spark), learned).collect() == []
    assert {(r.lang_pred, r.score) for r in langid.predict(awkward(spark), learned).collect()} == {("und", 0.0)}


def test_langid_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    got = langid.query(spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_langid_groups_are_whole(spark):
    """A text's n-grams do not depend on what stands beside it."""
    all_texts = [t for _, t in texts()]
    found, edge = langid.grams(all_texts)
    for k, t in itertools.islice(enumerate(all_texts), 0, None):
        own, _ = langid.grams([t])
        assert np.array_equal(np.sort(found[edge[k] : edge[k + 1]]), np.sort(own))
