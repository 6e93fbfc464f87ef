"""Quality rules, decontamination, packing, token counts, sharding: edge rows and brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteflow.llm import decontaminate, packing, quality_rules, sharding, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GOOD = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(8))


def docs(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# ---- quality rules --------------------------------------------------------

def expected_repeats(words):
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
    return len(hit)


def test_base_counts_match_a_plain_version(spark):
    rng = np.random.RandomState(3)
    texts = [" ".join(rng.choice(list("abcde"), size=n)) for n in (0, 1, 2, 3, 4, 10, 60, 200)]
    texts += ["x\ty\x0bz\x0c q\r\n\n a  b", "l one\nl one\n \nl one\nother", "# * $ % & | < > a#b", "a\x1cb \x85 c"]
    got = {r.doc_id: r for r in quality_rules.quality(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0d]+", t)
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert got[i].n_words == len(words)
        assert got[i].word_chars == sum(map(len, words))
        assert got[i].n_symbols == sum(t.count(c) for c in "#*$%&|<>")
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].n_repeat_words == expected_repeats(words), t


def test_both_ways_of_finding_repeats_agree(spark):
    rng = np.random.RandomState(5)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(size)], size=400)) for size in (4, 8, 12, 20, 60)]
    got = [r.n_repeat_words for r in quality_rules.quality(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == [expected_repeats(t.split()) for t in texts]


def test_lines_are_judged_first_and_losses_reject(spark):
    junk = "home | about | contact | login | help"
    shout = " ".join(["BUY!!"] * 30)
    texts = [GOOD, GOOD + "\n" + junk, shout + "\n" + GOOD,
             "\n".join([junk.replace("home", f"home{i}") for i in range(40)]) + "\n" + GOOD, None, ""]
    got = {r.doc_id: r for r in quality_rules.quality(docs(spark, texts)).collect()}
    assert [got[i].kept for i in range(6)] == [True, True, True, False, False, False]
    assert got[1].n_bad_lines == 1 and got[1].cleaned == GOOD
    assert got[4].base_failed and got[4].n_words == 0


def test_punctuation_and_menus_by_line_in_any_script(spark):
    menus = ["Home\nAbout us\nOur team", "首页\n关于我们\n联系我们\n登录", "Главная\nО нас \nКонтакты\t"]
    gone = [*menus, "Read the whole story...", "Weiterlesen … ", "--- * --- =", "»"]
    stays = ["A heading", "One\nTwo", "Roses are red,\nviolets are blue,\nsugar is sweet.", "\u201cYes.\u201d\n\u201cNo.\u201d\n(Maybe.)",
             "Home\n\nAbout us\n\nOur team", "はい。\nいいえ。\nたぶん。", "3\n4.", " ".join(["word"] * 13) + "..."]
    texts = [GOOD + "\n" + x + "\n" + GOOD.replace("w", "v") for x in gone + stays]
    got = {r.doc_id: r for r in quality_rules.quality(docs(spark, texts)).collect()}
    for i, x in enumerate(gone):
        assert got[i].n_bad_lines == x.count("\n") + 1 and got[i].kept, x
        assert got[i].cleaned == GOOD + "\n" + GOOD.replace("w", "v")
    for i, x in enumerate(stays, len(gone)):
        assert got[i].n_bad_lines == 0 and got[i].cleaned == texts[i], x
    many = "\n".join(f"link {i}" for i in range(60))
    lost = quality_rules.quality(docs(spark, [many + "\n" + GOOD])).first()
    assert not lost.kept and lost.n_bad_lines == 60 and lost.n_lost_words == 120


def test_quality_sql_judges_the_same_lines(spark):
    import duckdb

    from tasteflow.llm.oracle import SQL

    rnd = np.random.RandomState(11)
    pieces = ["Home", "About us", "A full sentence.", "", "  ", "Read on...", "…", "首页", "一句话。", "x | y | z", "## $$ %%", "(so.)\r",
              "\u201cYes.\u201d", "Terms of use", "BUY!! NOW!!", "one two three four", "one two three four five", "a\x85", "b\u2028"]
    texts = ["\n".join(rnd.choice(pieces, size=n)) + "\n" + GOOD for n in rnd.randint(0, 30, size=150)] + [None, ""]
    df = docs(spark, texts)
    documents = df.toPandas()  # noqa: F841
    with duckdb.connect() as db:
        db.register("documents", documents)
        want = {r[0]: r[1:] for r in db.execute(
            f"SELECT doc_id, n_bad_lines, n_lost_words, kept FROM ({SQL['op2_quality_rules']})").fetchall()}
    got = {r.doc_id: (r.n_bad_lines, r.n_lost_words, r.kept) for r in quality_rules.quality(df).collect()}
    assert got == want and len({k for _, _, k in got.values()}) == 2


def test_clean_keeps_columns_whatever_their_names(spark):
    df = docs(spark, [GOOD, GOOD + "\nAll rights reserved.", None]).withColumn("kept", F.lit(7)).withColumn(
        "row", F.lit("x")).withColumn("n_bad_lines", F.lit(None).cast("string"))
    out = quality_rules.clean(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {0, 1} and rows[1].text == GOOD and rows[1].n_chars == len(GOOD) and rows[0].kept == 7
    assert quality_rules.clean(df.limit(0)).count() == 0


def test_quality_plan_is_one_projection(spark):
    plan = quality_rules.quality(docs(spark, [GOOD]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# ---- decontamination ------------------------------------------------------

def brute_hits(text, items, window):
    def norm(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = norm(text), set(), set()
    for item, t in items:
        w = norm(t)
        size = min(window, len(w))
        wins = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1):
            if wins and tuple(words[i:i + size]) in wins:
                hit |= set(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_windows_match_brute_force(spark, block_words):
    rng = np.random.RandomState(1)
    vocab = ["the", "cat", "Sat", "é", "naïve", "42", "on", "mat"]
    items = [(i, " ".join(rng.choice(vocab, size=n))) for i, n in enumerate((2, 3, 4, 5, 6, 9))]
    items += [(0, "unrelated words entirely"), (None, "cat cat cat"), (9, None), (10, "-- !!"), (11, items[3][1])]
    texts = [", ".join(rng.choice(vocab, size=n)) for n in rng.randint(0, 60, size=60)] + [None, "", "cat Cat_CAT"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.report(docs(spark, texts), bench, window=4, block_words=block_words).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, hit, found = brute_hits(t, items, 4)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (n, hit, len(found)), t
        assert got[i].items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert got[i].contaminated == bool(hit)


def test_offsets_point_into_the_original(spark):
    text = "Çà — Then, THE quick; brown-fox naïve end"
    bench = spark.createDataFrame([(1, "the QUICK brown fox")], "item_id bigint, text string")
    row = decontaminate.scan(docs(spark, [text]), bench, window=4).first()
    place = row.hit_bytes[0]
    assert text.encode()[place.start:place.end].decode() == "THE quick; brown-fox"


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    df = docs(spark, ["a b", None]).withColumn("hit_items", F.lit(1)).withColumn("row", F.lit(2))
    assert decontaminate.clean(df, none).count() == 2
    assert decontaminate.clean(df, none).columns == df.columns
    assert decontaminate.report(df.limit(0), none).count() == 0


# ---- packing --------------------------------------------------------------

@pytest.fixture(scope="module")
def tokens():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as public

    reference = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return public, lambda t: [*reference.encode(t or "", add_special_tokens=False).ids, 1]


TRICKY = ["", None, "one", " lead", "trail ", "two  spaces", "tab\there", "a\n b", "line\nline", "it's we'll  don 't",
          "naïve çà 日本 語", "x" * 300, "<|endoftext|> in text", "two  <|endoftext|>\n<|endoftext|>s", "<|endoftext| >", "\n\n \n", " " * 50 + "a", "émoji 😀 ok", "a\u00a0b c"]


def test_ids_equal_the_tokenizer(tokens):
    public, reference = tokens
    bpe = packing.ByteBpe(public.path("byte_bpe_50k.tiktoken"), public.PATTERN, segment=3)
    for t in TRICKY + [" ".join(TRICKY[2:])]:
        assert [*bpe.ids(t or ""), 1] == reference(t)


def test_pieces_are_a_round_trip(spark, tokens):
    public, reference = tokens
    rng = np.random.RandomState(0)
    texts = TRICKY + [" ".join(rng.choice(TRICKY[2:12], size=n)) for n in (50, 400, 5, 90, 33, 600)] + ["same"] * 5
    out = packing.packed(docs(spark, texts), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, length=64,
                         group_rows=8, chunk=5).collect()
    by_doc = {}
    for p in out:
        by_doc.setdefault(p.doc_id, []).append(p)
    for i, t in enumerate(texts):
        ids, at = reference(t), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    sequences = {}
    for p in out:
        sequences.setdefault(p.sequence_id, []).append(p)
    short = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
        short += at < 64
    assert short <= -(-len(texts) // 5) + 4


def test_pack_balances_cost_and_fills():
    lengths = [int(x) for x in np.random.RandomState(2).randint(0, 2048, size=500)]
    pieces = packing.pack(lengths, 2048)
    used = {}
    for i, start, n, s in pieces:
        used[s] = used.get(s, 0) + n
    assert sum(used.values()) == sum(lengths) and max(used.values()) <= 2048
    assert len(used) == -(-sum(lengths) // 2048)


def test_packing_nothing(spark, tokens):
    public, _ = tokens
    assert packing.packed(docs(spark, []), public.path("byte_bpe_50k.tiktoken"), public.PATTERN).count() == 0


# ---- token counts ---------------------------------------------------------

def brute_count(word, pieces):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        fall = len(word[end - 1].encode())
        options = [(best[end - 1][0] + token_counts.BYTE_LOG_PROB * fall, best[end - 1][1] - fall)]
        options += [(best[s][0] + pieces[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in pieces]
        best.append(max(options))
    return -best[-1][1]


def test_trie_counts_equal_word_by_word(spark):
    import public_tokenizers as public

    path = public.path("piece_bpe_32k.model")
    pieces = token_counts.zipf_pieces(path)
    texts = ["the theory then thereof", None, "", "日本 naïve 😀", "a\tb\nc", "pre prefix prefixes prefixed " * 20]
    got = {r.doc_id: r for r in token_counts.token_counts(docs(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        assert got[i].n_pretokens == len(words)
        assert got[i].n_tokens == sum(brute_count(token_counts.MARK + w.decode(), pieces) for w in words)


def test_dropping_the_trie_changes_no_count():
    pieces = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -3.5, "ba": -9.0}
    words = ["".join(w).encode() for w in np.random.RandomState(1).choice(list("abc"), size=(300, 6))]
    small, large = token_counts.PrefixTrie(pieces, max_nodes=5), token_counts.PrefixTrie(pieces)
    assert [small.tokens(w) for w in words] == [large.tokens(w) for w in words]
    assert [large.tokens(w) for w in words] == [brute_count("▁" + w.decode(), pieces) for w in words]


def test_words_seen_outlive_the_nodes():
    pieces = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -3.5, "ba": -9.0}
    trie = token_counts.PrefixTrie(pieces, max_nodes=12)
    assert trie.tokens(b"abba") == brute_count("▁abba", pieces)
    trie.tokens(b"bbbbbbbbbb")
    trie.tokens(b"aaa")  # drops the nodes
    assert len(trie.score) == 5 and b"abba" in trie.terminal
    words = [bytes([97 + i, 97 + j]) for i in range(5) for j in range(5)]
    assert trie.total(words) == sum(brute_count("▁" + w.decode(), pieces) for w in words)
    assert len(trie.terminal) <= 13  # these have a bound of their own


def test_pieces_that_end_at_a_letter():
    rng = np.random.RandomState(5)
    pieces = {"".join(rng.choice(list("abé"), size=n)): -float(n) for n in (1, 2, 2, 3, 4, 5, 6, 6)}
    ends, word, state = token_counts.PieceEnds(pieces), "".join(rng.choice(list("abéz"), size=400)), 0
    for end in range(1, len(word) + 1):
        state = ends.after(state, word[end - 1])
        want = {(n, pieces[word[end - n:end]]) for n in range(1, 7) if end >= n and word[end - n:end] in pieces}
        assert set(ends.found[state]) == want and len(ends.found[state]) == len(want)


def test_long_words_leave_the_trie_small():
    pieces = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -3.5, "ba": -9.0}
    word = "".join(np.random.RandomState(2).choice(list("abc"), size=3000))
    trie = token_counts.PrefixTrie(pieces)
    assert trie.tokens(word.encode()) == brute_count("▁" + word, pieces)
    assert len(trie.score) == 1 and not trie.terminal
    assert trie.tokens(b"a" * 1_000_000) == 1_000_001


def test_token_counts_of_repeated_rows_clashing_columns_and_no_rows(spark):
    import public_tokenizers as public

    path = public.path("piece_bpe_32k.model")
    df = docs(spark, ["same text", "same text"]).withColumn("n_tokens", F.lit("x")).withColumn("n_bytes", F.lit(1))
    out = token_counts.token_counts(df.unionByName(df), path)
    assert out.columns == ["doc_id", "n_pretokens", "n_tokens", "n_bytes"]
    assert sorted((r.doc_id, r.n_pretokens, r.n_bytes) for r in out.collect()) == [(0, 2, 9)] * 2 + [(1, 2, 9)] * 2
    assert token_counts.token_counts(df.limit(0), path).count() == 0


# ---- sharding -------------------------------------------------------------

def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = sharding.ShardTree.uniform(2, 2, 4)
    df = spark.range(20000)
    grown = tree
    for _ in range(3):
        before, grown = grown, grown.grow()
        out = sharding.assign(sharding.assign(df, "id", before, "a"), "id", grown, "b")
        assert out.where((F.col("a") != F.col("b")) & (F.col("b") != grown.n_shards - 1)).count() == 0
    sizes = [r["count"] for r in sharding.assign(df, "id", tree).groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)


def test_weights_give_shares_and_confine_movement(spark):
    a = sharding.ShardTree((((1.0, 3.0), (2.0,)), ((2.0,),)))
    b = sharding.ShardTree((((1.0, 3.0), (6.0,)), ((2.0,),)))
    out = sharding.assign(sharding.assign(spark.range(40000), "id", a, "a"), "id", b, "b").cache()
    share = {r.a: r["count"] / 40000 for r in out.groupBy("a").count().collect()}
    assert all(abs(share[s] - w / 8) < 0.02 for s, w in enumerate((1, 3, 2, 2)))
    # rows only leave region 1, or move within the grown region into its grown rack
    moved = {(r.a, r.b) for r in out.where("a <> b").select("a", "b").distinct().collect()}
    assert all(x == 3 or y == 2 for x, y in moved)


def test_slots_are_gapless_with_repeated_and_null_rows(spark):
    rows = [(1, "a")] * 50 + [(None, "b")] * 7 + [(None, None)] * 3 + [(i, "c") for i in range(100)]
    df = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, x string"), "doc_id",
                         sharding.ShardTree.uniform(1, 2, 2))
    out = sharding.slots(df, pieces=4)
    seen = {}
    for r in out.collect():
        seen.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, seen.values())) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())
    assert sharding.slots(df.limit(0)).count() == 0


@pytest.mark.parametrize("base", [2, 3, decontaminate.BASE])
def test_windows_whatever_the_alphabet(base):
    rnd = np.random.RandomState(1)
    text = lambda n: b" ".join(b"w%d" % i for i in rnd.randint(0, 12, size=n))
    items = [(f"i{k}", text(n)) for k, n in enumerate([0, 1, 2, 3, 3, 5, 9])]
    windows = decontaminate.Windows(items, 3, base)
    for _ in range(20):
        words = decontaminate.normal_words(text(60)) + [b"other"]
        want = set()
        for item, t in items:
            ws = decontaminate.normal_words(t)
            for i in range(max(len(ws) - 2, 1) if ws else 0):
                win = ws[i:i + 3]
                want |= {(at, at + len(win), item) for at in range(len(words)) if words[at:at + len(win)] == win}
        assert {(a, b, i) for a, b, ids in windows.hits(words) for i in ids} == want


def test_more_words_in_a_block_than_code_points():
    text = b" ".join(b"%x" % i for i in range(0x110000 + 5))
    windows = decontaminate.Windows([("i", text)], 2)
    hits = windows.hits(decontaminate.normal_words(b"x " + text[:400]))
    assert windows.places == 3 and len(hits) > 50 and hits[0][:2] == (1, 3)
