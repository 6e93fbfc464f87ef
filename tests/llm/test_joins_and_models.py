"""Suffix dedup, Jaccard join, URL filter, chat formatting, quality model: edge rows and brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteflow.llm import chat, graph, jaccard_join, quality_model, suffix_dedup, url_filter

DOCS = "doc_id bigint, text string"


# ---- suffix dedup ---------------------------------------------------------

def brute_cut(rows, length):
    def order(i):
        return (i is None, i or 0)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, dtype=int)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < order(i):
                gone[k + 1:k + length + 1] = 1
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n, alphabet="ab é"):
    """Random texts that share passages, with copies and long ones."""
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice(alphabet) for _ in range(rnd.choice((30, 50, 51, 70, 200)))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefghij \nü") for _ in range(rnd.randint(0, 90)))
                 for _ in range(rnd.randint(0, 5))]
        texts.append("".join(parts))
    return texts + [None, "", texts[0], texts[1], "z" * 400, "z" * 49, "yz" * 300]


@pytest.mark.parametrize("bucket_rows", [4, 2048])
def test_removed_bytes_match_brute_force(spark, bucket_rows):
    texts = corpus(bucket_rows, 60)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, texts))
    # repeated rows, one id with two texts, null ids
    rows += [rows[0], rows[3], (ids[5], texts[2]), (None, "q" * 60 + texts[4])]
    df = spark.createDataFrame(rows, DOCS)
    out = suffix_dedup.removed(df, bucket_rows=bucket_rows).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256).alias("sha"))
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute_cut(rows, 50)


def test_blocks_do_not_show(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    rnd = random.Random(4)
    texts = corpus(9, 30)
    ids = np.arange(len(texts), dtype=np.int64)
    raw = [(t or "").encode() for t in texts]
    number, start, end = suffix_dedup.repeated_spans(ids, raw, 50)
    exp = {e[0]: e for e in brute_cut(list(enumerate(texts)), 50)}
    for i in range(len(texts)):
        spans = sorted(zip(start[number == i], end[number == i]))
        assert len(spans) == exp[i][3] and sum(b - a for a, b in spans) == exp[i][2]
    assert rnd


def test_anchors_of_equal_folded_code_keep_their_homes(spark):
    drawn = np.random.default_rng(5).integers(97, 123, (200_000, 50), dtype=np.uint8)
    passages = [r.tobytes() for r in drawn]
    code = suffix_dedup.Runs(passages, 50).code
    fold = (code >> np.uint64(32)).astype(np.uint32) ^ code.astype(np.uint32)
    by = np.argsort(fold, kind="stable")
    pairs = [(passages[i].decode(), passages[j].decode()) for i, j in zip(by, by[1:])
             if fold[i] == fold[j] and code[i] != code[j]]
    assert pairs
    homes = suffix_dedup._home(np.arange(40, dtype=np.int64), np.zeros(40, np.uint32), 40)
    one, other = 0, int(np.flatnonzero(homes != homes[0])[0])
    texts = {one: pairs[0][0], other: pairs[0][1], 39: pairs[0][0] + " - " + pairs[0][1]}
    rows = [(i, texts.get(i, "".join(p.decode() for p in passages[4 * i:4 * i + 4]).upper())) for i in range(40)]
    out = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket_rows=1)
    assert {r.id: r.n_removed for r in out.where("n_removed > 0").selectExpr("row.doc_id id", "n_removed").collect()} == {39: 100}


def test_a_passage_of_many_documents_is_no_group(monkeypatch, spark):
    spans, unpack = suffix_dedup.repeated_spans, suffix_dedup._unpack

    def few_segments(ids, texts, length):
        assert len(texts) <= 60
        return spans(ids, texts, length)

    def few_owners(blobs, *types):
        out = unpack(blobs, *types)
        assert types[-1] != "<u4" or np.unique(out[0], return_counts=True)[1].max(initial=0) <= 60
        return out

    monkeypatch.setattr(suffix_dedup, "repeated_spans", few_segments)
    monkeypatch.setattr(suffix_dedup, "_unpack", few_owners)
    rnd = random.Random(6)
    draw = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    footer, few = draw(300), draw(120)
    rows = [(i, draw(80) + (few if i % 100 == 7 else "") + draw(20) + (footer if i % 3 else "") + draw(i % 2 * 30))
            for i in range(600)]
    out = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket_rows=20).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256))
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute_cut(rows, 50)


def test_clean_keeps_columns_and_valid_text(spark):
    shared = "é" * 30
    df = spark.createDataFrame(
        [(0, "A" + shared + "è tail one", 1, "x"), (1, "B" + shared + "ë tail two", 2, "y"), (2, "A" + shared + "è tail one", 3, "z"),
         (3, None, 4, None)], "doc_id bigint, text string, rest int, row string")
    out = suffix_dedup.clean(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {0, 1, 3} and rows[1].text == "B tail two" and rows[1].rest == 2
    assert suffix_dedup.clean(df.limit(0)).count() == 0


# ---- Jaccard join ---------------------------------------------------------

def word_set(t, k=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute_components(rows, pct=90, k=3):
    sets = [word_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[find(i)] = min(least.get(find(i), id_), id_)
    return sorted([(id_, len(sets[i]), least.get(find(i))) for i, (id_, _) in enumerate(rows)], key=str)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        if not words:
            break
        at = rnd.randrange(len(words))
        words[at:at + 1] = rnd.choice(([], ["new%d" % rnd.randrange(10 ** 6)], [words[at], "ins%d" % rnd.randrange(10 ** 6)]))
    return " ".join(words)


@pytest.mark.parametrize("pct, k, rounds", [(90, 3, 3), (80, 5, 3), (55, 2, 1), (90, 3, 0), (80, 5, 0)])
def test_components_match_brute_force(spark, pct, k, rounds):
    """With no rounds of contraction the token-group matrix is the only source of links."""
    rnd = random.Random(pct)
    vocab = [f"v{i}" for i in range(400)]
    shared = [rnd.choice(vocab) for _ in range(55)]
    rows = []
    for n in (1, 2, 3, 4, 8, 9, 10, 11, 12, 15, 20, 40, 80, 200, 500):
        base = [rnd.choice(vocab) for _ in range(n)]
        for copy in range(12):
            rows.append(edited(rnd, base, rnd.randrange(0, max(1, n // 20) + 2) if copy else 0))
    rows += [" ".join(shared + [rnd.choice(vocab) for _ in range(rnd.randrange(12))]) for _ in range(40)]
    rows += [None, "", " \n", rows[3].upper(), rows[40], rows[41]]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    rows = list(zip(ids, rows)) + [(ids[7], rows[7]), (None, rows[9]), (None, "only here at all")]
    got = jaccard_join.report(spark.createDataFrame(rows, DOCS).repartition(3), k=k, pct=pct, rounds=rounds)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows, pct, k)


@pytest.mark.parametrize("pct", [90, 80])
def test_every_link_shares_a_group(pct):
    """Pairs at the very limit, of all sizes."""
    rnd = np.random.RandomState(0)
    for _ in range(600):
        n = int(rnd.choice([rnd.randint(1, 30), rnd.randint(30, 400), rnd.randint(400, 5000)]))
        a = np.unique(rnd.randint(0, 2 ** 62, size=n).astype(np.uint64))
        n = len(a)
        drop = rnd.randint(0, n - -(-n * pct // 100) + 1)
        room = n - drop  # tokens in common; b may add as many as the limit allows
        new = rnd.randint(0, 2 ** 62, size=max(0, room * 100 // pct - n)).astype(np.uint64)
        b = np.unique(np.r_[a[drop:], new])
        both = len(np.intersect1d(a, b))
        assert both * 100 >= pct * (len(a) + len(b) - both)
        if not np.array_equal(a, b):
            assert len(np.intersect1d(jaccard_join.group_keys(a, pct), jaccard_join.group_keys(b, pct)))


def test_deduplicate_keeps_one_of_each(spark):
    base = " ".join(f"t{i}" for i in range(100))
    rows = [(4, base, "a"), (2, base + " more", "b"), (2, base + " more", "b"), (9, None, "c"), (8, "", "d"), (7, "other text here", "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string")
    out = jaccard_join.deduplicate(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.node) for r in out.collect()) == [(2, "b"), (7, "e"), (8, "d"), (9, "c")]
    assert jaccard_join.deduplicate(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    out = graph.components(chain.unionByName(spark.createDataFrame([(1000, 1001)], "a bigint, b bigint")))
    assert {(r.node, r.root) for r in out.collect()} == {(i, 0) for i in range(200)} | {(1000, 1000), (1001, 1000)}


# ---- URL filter -----------------------------------------------------------

RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
         url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/")]


def test_hosts_paths_and_longest_rules(spark):
    cases = {
        "http://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.www.example.com/en/1": ("x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://b.net/es/q": ("b.net", "/es/q", "net/es/", "block"),
        "http://b.com": ("b.com", "", None, None), "http://b.com?x=/en/": ("b.com", "", None, None),
        "b.com/en/": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None),
        "x://h#f://g/": ("h", "", None, None), "http://É.com/": ("É.com", "/", "com/", "allow"),
    }
    rows = [(i, u, "<p>some words</p>") for i, u in enumerate(cases)]
    rows += [rows[0], (None, rows[4][1], None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    out = url_filter.judge(df, RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = cases[rows[r.page_id][1]] if r.page_id is not None else list(cases.values())[4]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0), RULES).count() == 0


def test_segmentation_and_bayes_match_a_plain_version(spark):
    import math

    rnd = random.Random(2)
    words = ["cheap", "pills", "news", "daily", "casino", "paper", "win", "shop"]
    pages = []
    for i in range(120):
        bad = i % 2
        name = "".join(rnd.sample(words[:2] + words[4:5] + words[6:7] if bad else words[2:4] + words[5:6] + words[7:], 2))
        top = rnd.choice(["com", "org"]) if not bad else rnd.choice(["net", "org"])
        pages.append((i, f"http://{name}.{top}/{'es' if bad else 'a'}/{name}/{i}", "<b>" + " ".join(rnd.sample(words, 5)) + "</b>"))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    out = {r.page_id: r for r in url_filter.judge(df, RULES).collect()}
    counts = {r.word: r.n for r in url_filter.word_counts(df, "html").collect()}
    total = sum(counts.values())

    def tokens(host, path):
        parts = [p for p in re.split(r"[^\w]+", re.sub("[0-9]+", "0", path)) if p]
        return ["h:" + w for x in host.split(".") for w in url_filter.best_split(x, counts, total)] + ["p:" + p for p in parts]

    assert url_filter.best_split("cheappills", counts, total) == ["cheap", "pills"]
    urls = {(r.host, r.path): r for r in out.values()}
    action = {"net/es/": 1, "com/": 0}
    seen = {}
    for (host, path), r in urls.items():
        if r.rule:
            for t in tokens(host, path):
                seen.setdefault(t, [0, 0])[action[r.rule]] += 1
    a, b = sum(v[0] for v in seen.values()) + len(seen), sum(v[1] for v in seen.values()) + len(seen)
    n = [sum(1 for r in urls.values() if r.rule and action[r.rule] == c) for c in (0, 1)]
    for (host, path), r in urls.items():
        score = math.log(n[1] / n[0]) + sum(math.log((seen[t][1] + 1) / b) - math.log((seen[t][0] + 1) / a)
                                            for t in tokens(host, path) if t in seen)
        assert abs(r.score / 1e6 - score) < 1e-4
        assert r.rule or r.verdict == ("block" if r.score > 0 else "allow")


def every_split(label, counts, total):
    """Score in micro-nats, number of words and the words of every split of a label."""
    import math

    for cuts in range(1 << max(0, len(label) - 1)):
        parts, at = [], 0
        for i in range(1, len(label) + 1):
            if i == len(label) or cuts >> (i - 1) & 1:
                parts.append(label[at:i])
                at = i
        micro = sum(round(1e6 * math.log(counts[w])) if w in counts else -(len(w) - 1) * round(1e6 * math.log(10))
                    for w in parts) - len(parts) * round(1e6 * math.log(max(total, 1)))
        yield micro, -len(parts), parts


def test_best_split_equals_every_split_tried():
    rnd = random.Random(5)
    for _ in range(150):
        counts = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4))): rnd.choice([1, 2, 5, 40])
                  for _ in range(rnd.randint(0, 6))}
        total = sum(counts.values()) + rnd.choice([0, 3, 1000])
        label = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))
        splits = list(every_split(label, counts, total))
        got = url_filter.best_split(label, counts, total)
        assert "".join(got) == label
        top = max(s[:2] for s in splits)
        assert got in [parts for *score, parts in splits if tuple(score) == top]


def test_long_labels_and_one_taught_class(spark):
    long = "cheappills" * 400 + "z" * 2000
    rows = [(1, f"http://{long}.org/x", "cheap pills"), (2, "http://b.net/es/q", "cheap pills"), (3, None, None)]
    out = {r.page_id: r for r in url_filter.judge(
        spark.createDataFrame(rows, "page_id bigint, url string, html string"), RULES).collect()}
    assert out[1].host == long + ".org" and out[2].verdict == "block"
    assert out[1].verdict == out[3].verdict == "allow"  # only blocked URLs were taught
    words = url_filter.segmented(spark.createDataFrame([(long,)], "label string"),
                                 spark.createDataFrame([("cheap", 9), ("pills", 9)], "word string, n bigint")).first().words
    assert words == ["cheap", "pills"] * 400 + ["z" * 2000]


# ---- chat -----------------------------------------------------------------

def brute_chat(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            x = f"<|im_start|>{'user' if role is None else role}\n{text or ''}<|im_end|>\n"
            convs.setdefault(conv, []).append((turn is not None, turn or 0, x))
    full = {c: tuple(x for _, _, x in sorted(v)) for c, v in convs.items()}
    out = {}
    for c, v in full.items():
        if not any(len(o) > len(v) and o[:len(v)] == v for o in full.values()):
            best = min(k for k, o in full.items() if o == v)
            out[best] = (len(v), sum(o == v for o in full.values()), "".join(v))
    return out


def test_maximal_conversations_match_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(60):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rnd.choice("ab")) for t in range(rnd.randint(1, 5))]
    rows += [(100, None, None, None), (101, 0, "user", "a"), (101, 0, "user", "a"), (None, 0, "user", "lost"), (102, 3, None, "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("k", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_logged, r.rendered) for r in chat.render(df).collect()}
    assert got == brute_chat(rows)
    assert chat.render(df.limit(0)).count() == 0


# ---- quality model --------------------------------------------------------

def test_rising_steps_is_isotonic_least_squares():
    knots, values = quality_model.rising_steps([(0, 1, 0.0), (1, 1, 1.0), (2, 1, 0.0), (3, 2, 0.5), (4, 1, 1.0)])
    assert list(values) == pytest.approx([0.0, 0.5, 1.0]) and list(knots) == pytest.approx([0.0, 2.25, 4.0])


def test_scores_learn_from_training_rows_only(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        words = ["word%d" % rnd.randrange(500) for _ in range(rnd.randrange(20, 200))]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        held = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, int(good) if not held else int(not good)))  # held-out labels are wrong: they must not matter
    rows += [(1000, None), (1001, ""), (1002, "x" * 200_000), rows[5], (None, "null id")]
    labels += [(1, 1), (2, None), (None, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("y", F.lit("clash")).withColumn("x", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    out = quality_model.scored(docs, marks).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 400:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    right = sum(r.predicted == int(r.doc_id % 3 > 0) for r in out if r.doc_id is not None and r.doc_id < 400)
    assert right >= 395
    blank = quality_model.scored(docs, marks.limit(0)).first()
    assert blank.score == 0.5 and blank.predicted == 1
    assert quality_model.scored(docs.limit(0), marks).count() == 0


def test_normal_equations_equal_one_matrix(spark):
    rng = np.random.RandomState(0)
    x, y = rng.normal(size=(200, len(quality_model.STATISTICS))), rng.randint(0, 2, size=200).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)
    kernel = quality_model.Kernel(x.mean(0), x.std(0), features=16)
    a, b = quality_model.normal_equations(df, kernel, branches=3)
    z = kernel.map(x)
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)


def test_group_keys_are_dealt_once(spark, monkeypatch):
    plans, write = [], jaccard_join.written

    def spied(df, label, *more):
        if label == "members":
            plans.append(sorted(map(tuple, df.collect())))
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, *more)

    monkeypatch.setattr(jaccard_join, "written", spied)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(reversed(words)))]
    found = jaccard_join.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}
    assert len({node for node, _ in plans[0]}) == 2 and "ReusedExchange" in plans[1]


def test_jaccard_join_large_component_is_not_opened(spark):
    """Classes meet a large component only where bits allow a link, and no link is lost."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 120, dtype=np.uint64)

    def copy(changes):
        kept = rng.permutation(base)[changes:]
        return np.unique(np.r_[kept, rng.integers(0, 1 << 62, changes, dtype=np.uint64)])

    large = [copy(int(c)) for c in rng.integers(0, 6, 60)]
    asked = [copy(int(c)) for c in rng.integers(0, 14, 60)]
    asked += [np.unique(np.r_[large[i][2:], rng.integers(0, 1 << 62, 2, dtype=np.uint64)]) for i in range(8)]
    row = lambda i, s: (7, i, len(s), [int(x) for x in jaccard_join.token_bits(s)])
    found = jaccard_join._near_reference(
        spark.createDataFrame([row(1000 + i, s) for i, s in enumerate(asked)], "large long, q long, q_n long, q_bits array<long>"),
        spark.createDataFrame([row(i, s) for i, s in enumerate(large)], "large long, node long, n long, bits array<long>"), 90)
    got = {(r.q, r.node) for r in found.collect()}
    links = {(1000 + i, j) for i, a in enumerate(asked) for j, b in enumerate(large)
             if 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b))}
    assert links and links <= got
    assert len(got) < len(large) * len(asked) / 2


def test_jaccard_join_few_leaders_a_class(spark):
    stars = spark.createDataFrame([(a, b, a % 3 + 1) for b in range(4) for a in range(100, 130)], "a long, b long, agreed long")
    got = jaccard_join._nearest(stars).groupBy("b").count().collect()
    assert len(got) == 4 and all(r["count"] == jaccard_join.LEADERS for r in got)
    assert {r.a % 3 for r in jaccard_join._nearest(stars).collect()} == {2}


def test_jaccard_join_parity_bits_rule_out_large_sets(spark):
    rng = np.random.default_rng(7)
    rows, pairs, linked = [], [], set()
    cases = [(3000, 3000, 2000), (3000, 3000, 2500), (3000, 3000, 2668), (1030, 1010, 910), (1030, 1010, 650), (300, 300, 200),
             (300, 300, 270), (260, 250, 235)]
    for at, (n_a, n_b, shared) in enumerate(cases):
        tokens = rng.integers(0, 2**64, n_a + n_b - shared, dtype=np.uint64)
        sets = np.sort(tokens[:n_a]), np.sort(tokens[n_a - shared:])
        for node, x in zip((2 * at, 2 * at + 1), sets):
            parity = [int(w) for w in jaccard_join.token_parity(x)] if len(x) >= jaccard_join.PARITY else None
            rows.append((node, len(x), [int(w) for w in jaccard_join.token_bits(x)], parity))
        pairs.append((2 * at, 2 * at + 1))
        both = len(np.intersect1d(*sets))
        if 100 * both >= 80 * (len(sets[0]) + len(sets[1]) - both):
            linked.add(pairs[-1])
    df = spark.createDataFrame(rows, "node long, n long, bits array<long>, parity array<long>")
    kept = {tuple(r) for r in jaccard_join._plausible(spark.createDataFrame(pairs, "a long, b long"), df, 80).collect()}
    assert len(linked) == 4 and linked <= kept  # no link is lost, on different numbers of places either
    assert not kept & {(0, 1), (2, 3), (8, 9), (10, 11)}


def test_jaccard_join_stores_no_keys(spark):
    docs = spark.createDataFrame([(i, f"one two three four {i}") for i in range(4)], "doc_id long, text string")
    assert "keys" not in jaccard_join._signatures(docs, "doc_id", "text", 3).columns
    index = jaccard_join._index(docs, "text", 3, 90)
    assert index.columns == ["node", "key"]


def test_suffix_dedup_hot_runs_open_only_what_changed(spark, monkeypatch):
    """Near copies with hot anchors: right spans, and only the windows of the changed runs are compared."""
    rng = np.random.default_rng(3)
    base = bytes(rng.integers(97, 123, 2000, dtype=np.uint8))
    texts = []
    for i in range(40):
        at = int(rng.integers(100, 1900))
        texts.append(base[:at] + b"%08d" % i + base[at + 8:])
    counted, kept = {}, suffix_dedup.written

    def counting(df, label, *more):
        out = kept(df, label, *more)
        counted[label] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "written", counting)
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "ord long, text binary")
    hot = np.unique(suffix_dedup.Runs(texts, 50).code)
    got = [set() for _ in texts]
    for r in suffix_dedup._hot_spans(docs, hot, 50).collect():
        got[r.ord].update(range(r.start, r.end))
    seen: set[bytes] = set()
    for i, t in enumerate(texts):
        windows = [t[k:k + 50] for k in range(len(t) - 49)]
        assert got[i] == {b for k, w in enumerate(windows) if w in seen for b in range(k, k + 50)}, i
        seen.update(windows)
    assert counted["suffix-windows"] < len(base) + 100 * len(texts)


def test_suffix_dedup_hot_share_does_not_fall_with_size(spark):
    """A passage in seven documents of a thousand is judged alike in a small and a large table."""
    common = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(120))
    for rows in (51_282, 256_410):
        holders = spark.range(0, rows * 7 // 1000, 1, 4).select(F.lit(common).cast("binary").alias("text"))
        assert len(suffix_dedup._hot(holders, rows, rows // 2048, 2048, 50)) == 0
