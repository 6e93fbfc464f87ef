"""Spelling variants, language identification, collocations: edge rows and brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tasteflow.llm import collocations, language_id, spelling_variants
from tasteflow.llm.common import written

DOCS = "doc_id bigint, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- spelling variants ----------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio):
    out = []
    for w, n in words.items():
        near = [o for o in words if one_edit(w, o)]
        best = min(near, key=lambda o: (-words[o], o.encode()), default=None)
        form = best if best and words[best] >= ratio * n else None
        out.append([w, form, w, n, len(near), words[form] if form else None])
    forms = {r[0]: r[1] for r in out}
    for r in out:
        while forms[r[2]]:
            r[2] = forms[r[2]]
    return sorted(map(tuple, out))


def brute_words(rows, least, slip=None):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def mutated(rnd, word, alphabet):
    p = rnd.randrange(len(word) + 1)
    kind = rnd.choice("idr")
    return word[:p] + (rnd.choice(alphabet) if kind != "d" else "") + word[p + (kind != "i"):]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefé"])
def test_near_pairs_match_brute_force(spark, alphabet):
    rnd = random.Random(len(alphabet))
    words = set()
    for size in [2, 3, 4, 5, 6, 7, 8, 11, 12, 13, 24, 25, 26, 47, 48, 49, 60] * 4:
        word = "".join(rnd.choice(alphabet) for _ in range(size))
        words |= {word, *(mutated(rnd, word, alphabet) for _ in range(5))}
    words |= {"a" * n for n in range(2, 40)}
    words = sorted(w for w in words if len(w) >= 2)
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    got = sorted(tuple(sorted((r.a, r.b))) for r in spelling_variants.near_pairs(df).collect())
    assert got == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1:] if one_edit(a, b))


def word_rows():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(7, 14))) for _ in range(12)]
    texts = []
    for _ in range(80):
        words = [rnd.choice(base[:4]) if rnd.random() < 0.7 else mutated(rnd, rnd.choice(base), "abcÀ") for _ in range(30)]
        texts.append(rnd.choice([" ", "-", "1 "]).join(w.upper() if rnd.random() < 0.1 else w for w in words))
    long = "x" * 5000
    rows = list(enumerate(texts)) + [(90, None), (91, ""), (None, texts[0]), (3, texts[3]), (3, texts[3]), (92, f"{long} {long} {long}y"),
                                     (93, f"{long}y short ×÷ abcdef"), (94, "ſİıK" * 3)]
    return [(i, t, "en") for i, t in rows]


@pytest.mark.parametrize("slip", [None, 3])
def test_variants_match_brute_force(spark, slip):
    rows = word_rows()
    want = brute_variants(brute_words(rows, 7, slip), 3)
    got = spelling_variants.variants(spark.createDataFrame(rows, DOCS), ratio=3, slip=slip)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] for r in want)


def test_chains_of_forms_end_at_the_root(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10_000, "aabbbbb": 100_000}
    forms = written(spelling_variants.with_forms(spark.createDataFrame(list(words.items()), "word string, n bigint")), "t")
    assert {r.word: r.root for r in spelling_variants.roots(forms).collect()} == {
        w: "aabbbbb" for w in words if w != "aabbbbb"}


def test_variants_of_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "abcdefgh abcdefgh abcdefgx abcdefgx", 2, "p", 3)],
                               "id bigint, word string, n int, part string, length int")
    got = spelling_variants.variants(df, "id", "word")
    assert sorted(map(tuple, got.collect())) == [("abcdefgh", None, "abcdefgh", 2, 1, None), ("abcdefgx", None, "abcdefgx", 2, 1, None)]
    assert spelling_variants.variants(spark.createDataFrame([], DOCS)).collect() == []
    assert spelling_variants.variants(spark.createDataFrame([(1, None, None)], DOCS)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants.near_pairs(df, 1)


# ---- language identification ----------------------------------------------

def plain_grams(text):
    """Bucket of every n-gram, one character at a time."""
    out, mask = [], (1 << 64) - 1
    for at in range(0, max(len(text), 1), language_id.PIECE):
        t = re.sub(r"[\W\d_]+", " ", f" {text[at:at + language_id.PIECE].lower()} ")
        for n in language_id.ORDERS:
            for i in range(len(t) - n + 1):
                g = t[i:i + n]
                if g == " ":
                    continue
                h = 0
                for c in g:
                    h = (h + ord(c)) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 29
                out.append((h * 0x9E3779B97F4A7C15 & mask) >> 48)
    return out


def plain_model(rows):
    counts, docs = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str("" if i is None else i).encode()) % 3 != 1:
            counts[lang].update(plain_grams(text or ""))
            docs[lang] += 1

    def predict(text):
        if not text or not any(map(str.isalpha, text)) or not docs:
            return "und", 0.0
        scores = {}
        for lang in sorted(docs):
            total = sum(counts[lang].values()) + language_id.SMOOTHING * language_id.BUCKETS
            scores[lang] = math.log(docs[lang] / sum(docs.values())) + sum(
                math.log((counts[lang][b] + language_id.SMOOTHING) / total) for b in plain_grams(text))
        best = max(scores, key=scores.get)
        return best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())

    return predict


def language_rows():
    rnd = random.Random(2)
    make = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 6)))
    letters = {"aa": "abcdeé", "bb": "cdefghü", "cc": "aeiouxyz", "dd": "яабв"}
    rows = [(i, make(letters[lang]) + rnd.choice(["", ". 12", "\n! "]), lang) for i, lang in enumerate(sorted(letters) * 30)]
    return rows + [(200, None, "aa"), (201, "", "bb"), (202, "123 ... ×", "cc"), (203, "abc", None), (None, "xyz aeiou", "cc"),
                   (5, rows[5][1], rows[5][2]), (204, "É" * 3, None)]


@pytest.mark.parametrize("block", [1, 32])
def test_predictions_match_a_plain_model(spark, block):
    rows = language_rows()
    docs = spark.createDataFrame(rows, DOCS)
    counts = written(language_id.learned(docs.where(~language_id.held_out(docs["doc_id"]))), "t")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in language_id.predicted(docs, counts, block=block).collect()), key=str)
    predict = plain_model(rows)
    want = sorted(((i, *predict(t)) for i, t, _ in rows), key=str)
    assert [(i, lang) for i, lang, _ in got] == [(i, lang) for i, lang, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want], rtol=1e-3, atol=1e-4)


def test_very_long_texts_are_read_in_pieces(spark):
    size = language_id.PIECE
    text = "abc é, " * (size // 5)
    number, bucket = language_id.features(list(language_id._pieces(text)))
    assert len(set(number.tolist())) == 2 and Counter(bucket.tolist()) == Counter(plain_grams(text))
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = list(zip(ids, ["abc " * 5, "xyz " * 5, text, "1" * (2 * size) + " abc"], ["aa", "bb", "aa", None]))
    got = language_id.identified(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.lang_pred for r in got} == dict(zip(ids, ["aa", "bb", "aa", "aa"]))


def test_language_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert language_id.identified(empty).collect() == []
    nothing = language_id.identified(spark.createDataFrame([(1, "abc", None), (2, None, None)], DOCS)).collect()
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in nothing) == [(1, "und", 0.0), (2, "und", 0.0)]
    df = spark.createDataFrame([(1, "abc", "aa", 7, 8, 9)], "row bigint, text string, lang string, best int, whole int, bucket int")
    got = language_id.identified(df, "row").collect()
    assert got[0].asDict() == {"row": 1, "held_out": zlib.crc32(b"1") % 3 == 1, "lang_pred": got[0].lang_pred, "score": got[0].score}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = found.count(), found.where("lang = lang_pred").count()
    assert n > 200 and right >= 0.98 * n


# ---- collocations -----------------------------------------------------------

@pytest.mark.parametrize("n,bits", [(2, 1), (2, 17), (2, 42), (3, 1), (3, 19), (3, 21), (3, 22), (3, 42)])
def test_packing_is_invertible(n, bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << bits, 5000, dtype=np.uint64) for _ in range(n)]
    packer = collocations.PackedNgrams(n, bits)
    high, low = packer.pack(ids)
    assert int(high.max()) < 1 << packer.halves[0] and int(low.max()) < 1 << packer.halves[1]
    assert all((a == b).all() for a, b in zip(ids, packer.unpack(high, low)))


@pytest.mark.parametrize("bits", [(1, 1), (3, 5), (17, 17), (30, 34), (42, 42), (63, 63)])
@pytest.mark.parametrize("shard_bits", [0, 1])
def test_filters_lose_nothing(bits, shard_bits):
    rng = np.random.default_rng(sum(bits))
    numbers = [tuple(rng.integers(0, 1 << b, dtype=np.uint64) for b in bits) for _ in range(300)]
    drawn = [numbers[i] for i in rng.zipf(1.3, 20_000) % 300]
    counted = lambda xs: collocations.QuotientFilter.counted(bits, *(np.array(x, np.uint64) for x in zip(*xs)))
    parts = []
    for some in (drawn[:9000], drawn[9000:9001], drawn[9001:]):
        parts += [collocations.QuotientFilter.load(raw, bits, shard_bits) for _, raw in counted(some).sections(shard_bits)]
    whole = collocations.QuotientFilter.merged(parts)
    got = {(int(a), int(b)): int(c) for a, b, c in zip(whole.high, whole.low, whole.counts)}
    assert got == Counter((int(a), int(b)) for a, b in drawn) and max(got.values()) > 255
    order = list(zip(whole.high.tolist(), whole.low.tolist()))
    assert order == sorted(order)


def brute_collocations(rows, least, k):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(len(q) > len(p) and (q[:2] == p or q[1:] == p) and 100 * b >= 50 * a for q, b in often.items()):
                continue
            score, _, left, right = min((10 ** 6 * a * a // (f[p[:c]] * f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:k], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows():
    rnd = random.Random(9)
    words = ["a", "B", "c", "dé", "É", "f\x00", "g\x1c", "h i", "Zz", "1-2"]
    sep = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "; "]
    text = lambda n: "".join(rnd.choice(words[:4] if rnd.random() < 0.6 else words) + rnd.choice(sep) for _ in range(n))
    rows = [(i, text(rnd.randint(0, 60)), rnd.choice(["x", "x", "y", None, "und"])) for i in range(120)]
    long = " ".join(rnd.choice(words) for _ in range(3000))
    return rows + [(200, None, "x"), (201, "", None), (202, "   \t", "z"), (3, rows[3][1], rows[3][2]), (None, long, "x"),
                   (203, "solo", "w"), (204, "w" * 3000, "w"), (205, "!?" * 50, "x")]


TINY = collocations.Sizes(chunk_tokens=37, chunk_words=9, shard_tokens=40, flush=50, step=2, slice=64)


@pytest.mark.parametrize("sizes,least,k", [(collocations.Sizes(), 10, 2000), (TINY, 10, 2000), (TINY, 3, 25), (TINY, 1, 2000)])
def test_collocations_match_brute_force(spark, sizes, least, k):
    rows = phrase_rows()
    got = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(3), min_count=least, k=k, sizes=sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, least, k)


def test_scores_are_exact_beyond_64_bits(spark):
    ids = spark.createDataFrame([("x", "p", 10 ** 14 + 3, 0), ("x", "q", 10 ** 14 + 7, 1)], "lang string, word string, n bigint, id bigint")
    a = 10 ** 14 - 1
    found = spark.createDataFrame([(2, 0, 1, None, a)], "n int, w1 bigint, w2 bigint, w3 bigint, a bigint")
    assert collocations.scored(found, ids).first().score == 10 ** 6 * a * a // ((10 ** 14 + 3) * (10 ** 14 + 7))


def test_collocations_of_empty_tables_and_clashing_columns(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    df = spark.createDataFrame([("u v " * 12, "x", 1, "t", 2)], "n string, chunk string, id int, word string, size int")
    got = collocations.collocations(df, "chunk", "n").collect()
    assert [(r.lang, r.rank, r.phrase, r.a) for r in got] == [("x", 1, "u v u", 11), ("x", 2, "v u v", 11)]
