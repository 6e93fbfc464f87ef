"""Exact n-gram Jaccard join with a token-group matrix.

A document's set holds its distinct word shingles.  Equal sets form one class,
and only classes are compared.

Groups.  The shingles are dealt by hash into buckets, a little more buckets than
two linked sets of such sizes can differ in.  Linked sets therefore agree on the
whole content of some bucket, and a group is the classes that agree on one:
every link lies inside at least one group.  Sizes are cut into bands so that
both sides use the same number of buckets.  (Empty contents are left out while
a set has so few of them that agreeing buckets remain.)

Contraction.  In every group each class is compared to a leader, and the links
found join classes into components.  Pairs inside one component need no further
look, which keeps thousands of near copies from becoming all pairs.  A few
rounds with other leaders join what the first leader was too far from.

Matrix.  What remains are groups with several components.  For each group and
component the matrix holds the union of the tokens of its classes and what they
all have, as hashed bits, and their size range.  Components that meet in a group and
may link by these make a pair, once however many groups they share.  For each
class of the first one, the bits that the second one's union lacks bound its
overlap with every member; only components that pass the bound are opened, large ones
through an index of what sets their members apart, and the members found are compared
one by one: first by sizes, bits and parity bits, then by whole sets.

Scale: texts are read once for the groups and once more to keep those of classes
that share a group.  Group leaders and unions are pre-aggregated; members meet
them in joins that split hot keys.  Sets are compared in a task that holds one
leader and streams its members.  Nothing goes through the driver but counts.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and are their own component; fewer words than a shingle form one
shingle of their own; repeated rows share a class; null ids never name a
component that has another id.  Set identity is 128 bits of hash; nodes are 64
bits and a collision between nodes raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls, written
from tasteflow.llm.graph import components

CALL = 1 << 20  # bytes of text, or of sets, handled at once
ROWS = 256      # rows of an Arrow batch that hold whole texts or sets
BITS = 1024     # hashed token bits of a set or a union
PARITY = 256    # tokens from which on a set has parity bits, too: its hashed bits fill up
LEADERS = 4     # leaders that a class is compared to in a round
FEW = 8         # classes of a component that is opened class by class
SPREAD = 140    # percent: sizes within one band differ by this factor at most (more for low thresholds)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal bits in, evenly spread bits out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hash of each word, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(texts: list[bytes], k: int, hashes: _WordHashes) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (ASCII lower-cased, cut at ASCII blanks)."""
    words = [t.lower().split() for t in texts]
    sizes = [len(w) for w in words]
    h = np.fromiter((hashes[w] for ws in words for w in ws), dtype=np.uint64, count=sum(sizes))
    code = _mix(h + np.uint64(k))
    rolled = code.copy()
    for i in range(1, k):
        rolled = _mix(rolled[:-1] + np.uint64(0x9E3779B97F4A7C15) * code[i:]) if len(rolled) > 1 else rolled[:0]
    out, at = [], 0
    for n in sizes:
        if n >= k:
            out.append(np.unique(rolled[at:at + n - k + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(code[at:at + n].tobytes(), seed=n)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def difference(total: int, pct: int) -> int:
    """Most tokens in which two linked sets with ``total`` tokens together can differ."""
    return total * (100 - pct) // (100 + pct)


@lru_cache(maxsize=None)
def scheme(band: int, pct: int) -> tuple[int, int, int, int]:
    """(edge, top, buckets, spare) of a band: its smallest own size, its largest size, and how sets are bucketed.

    A band holds sizes from its edge up to the next edge; sets beyond the next
    edge that can link with a member are grouped under it as well, up to ``top``.
    ``buckets`` is 0 where linked sets are equal sets.
    """
    spread, edge = max(SPREAD, 10_000 // pct + 1), 1
    for _ in range(band):
        edge = edge * spread // 100 + 1
    top = (edge * spread // 100) * 100 // pct
    most = difference(2 * top, pct)
    if not most:
        return edge, top, 0, 0
    empty = (most + 1) * math.exp(-edge / (most + 1))  # buckets that the smallest sets leave empty
    spare = max(2, math.ceil(empty + 4 * math.sqrt(empty)))
    return edge, top, most + 1 + spare, spare


def bands(n: int, pct: int) -> list[int]:
    """The bands under which a set of n tokens is grouped."""
    band = 0
    while scheme(band + 1, pct)[0] <= n:
        band += 1
    below = [band - 1] if band and n <= scheme(band - 1, pct)[1] else []
    return [b for b in [band, *below] if scheme(b, pct)[2]]


def group_keys(tokens: np.ndarray, pct: int) -> np.ndarray:
    """64-bit keys of the groups of a set: one per bucket content."""
    keys = []
    for band in bands(len(tokens), pct):
        _, _, buckets, spare = scheme(band, pct)
        spread = _mix(tokens + np.uint64(band + 1))
        bucket = (spread >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        content = np.add.reduceat(_mix(spread)[order], first)
        used = sorted_[first]
        if buckets - len(used) > spare:
            empty = np.setdiff1d(np.arange(buckets, dtype=np.uint64), used)
            used, content = np.r_[used, empty], np.r_[content, np.zeros(len(empty), dtype=np.uint64)]
        keys.append(_mix(content ^ _mix(used + np.uint64(band << 32))))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def token_bits(tokens: np.ndarray) -> np.ndarray:
    """The set's tokens as hashed bits, in 64-bit words."""
    bits = np.zeros(BITS, dtype=bool)
    bits[(_mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def token_parity(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's tokens falls on each place, in 64-bit words.

    Each token in which two sets differ turns one place, so they differ in at least as many tokens as places.  There are
    two to four places a token, always a power of two: the halves laid on each other are the set's bits on half the places.
    """
    places = 1 << (2 * len(tokens) - 1).bit_length()
    odd = np.bincount((_mix(tokens ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(places)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       blob(text_col).alias("text"))


def _signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, text_hash, n, node, digest, bits, parity) per document; a task gives the bits of equal sets once."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        for batch in calls(batches, "text", CALL):
            n, node, digests, bits, parity = [], [], [], [], []
            for tokens in shingle_sets(batch.column(2).to_pylist(), k, hashes):
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                new = len(tokens) and digest not in seen
                n.append(len(tokens))
                digests.append(digest)
                node.append(int.from_bytes(digest[:8], "little", signed=True))
                bits.append(token_bits(tokens) if new else None)
                parity.append(token_parity(tokens) if new and len(tokens) >= PARITY else None)
                seen.add(digest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(bits, pa.list_(pa.int64())), pa.array(parity, pa.list_(pa.int64()))],
                names=["id", "text_hash", "n", "node", "digest", "bits", "parity"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(
        kernel, f"id {id_type}, text_hash bigint, n bigint, node bigint, digest binary, bits array<bigint>, parity array<bigint>")


def _index(docs: DataFrame, text_col: str, k: int, pct: int) -> DataFrame:
    """(node, key): the groups of every class, from the texts themselves; a task gives those of equal sets once.

    They are larger than the texts, so they go straight to the exchange and are stored nowhere else.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        for batch in calls(batches, "text", CALL):
            node, keys = [], []
            for tokens in shingle_sets(batch.column(0).to_pylist(), k, hashes):
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                if len(tokens) and digest not in seen:
                    seen.add(digest)
                    keys.append(group_keys(tokens, pct).view(np.int64))
                    node.append(np.full(len(keys[-1]), int.from_bytes(digest[:8], "little", signed=True), np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(node)), pa.array(np.concatenate(keys))],
                                                 names=["node", "key"])

    return docs.select(blob(text_col).alias("text")).mapInArrow(kernel, "node bigint, key bigint")


def _missing(a: Column, b: Column) -> Column:
    """Bits set in ``a`` and not in ``b``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
                       F.lit(0), lambda s, x: s + x)


def _halved(parity: Column) -> Column:
    half = F.floor(F.size(parity) / 2).cast("int")
    return F.zip_with(F.slice(parity, F.lit(1), half), F.slice(parity, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _differing(a: Column, b: Column) -> Column:
    """Places in which the parity bits differ; null unless both sets have some, on as many places or twice as many."""
    return F.aggregate(F.zip_with(F.when(F.size(a) == 2 * F.size(b), _halved(a)).otherwise(a),
                                  F.when(F.size(b) == 2 * F.size(a), _halved(b)).otherwise(b),
                                  lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _plausible(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b, ...) that sizes, bits and parity bits do not rule out.

    The hashed bits of a large set are nearly all set and rule nothing out, so pairs that pass meet the parity bits.
    """
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    odd = lambda c: sets.where("parity is not null").select(F.col("node").alias(c), F.col("parity").alias(f"odd_{c}"))
    most = F.floor((F.col("n_a") + F.col("n_b")) * (100 - pct) / (100 + pct))
    own_a, own_b = _missing(F.col("bits_a"), F.col("bits_b")), _missing(F.col("bits_b"), F.col("bits_a"))
    both = (F.col("n_a") + F.col("n_b")) * pct  # of it (100 + pct) parts are shared tokens at least
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * pct)
        & (own_a + own_b <= most)
        & ((F.col("n_a") - own_a) * (100 + pct) >= both) & ((F.col("n_b") - own_b) * (100 + pct) >= both)
    ).select(*pairs.columns, most.alias("most")).join(odd("a"), "a", "left").join(odd("b"), "b", "left").where(
        F.coalesce(_differing(F.col("odd_a"), F.col("odd_b")), F.lit(0)) <= F.col("most")).select(*pairs.columns)


def _nearest(stars: DataFrame) -> DataFrame:
    """(a, b): of the leaders a of each class b, the ``LEADERS`` that agree with it in most groups.

    A whole set is then sent to so many leaders a round, however many groups the class is in.
    """
    order = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("agreed"), "a"))
    return stars.withColumn("nth", order).where(F.col("nth") <= LEADERS).select("a", "b")


def _candidate_texts(docs: DataFrame, names: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of one document of each given class.  ``names``: (id, text_hash, node) of that document."""
    texts, wanted = _texts(docs, id_col, text_col), names.join(nodes, "node", "left_semi").select("id", "text_hash", "node")
    return texts.join(wanted, texts["id"].eqNullSafe(wanted["id"]) & (texts["text_hash"] == wanted["text_hash"])
                      ).select("node", "text")


def _linked(pairs: DataFrame, texts: DataFrame, k: int, pct: int) -> DataFrame:
    """The pairs whose whole sets link."""
    pairs = written(pairs, "pairs")
    # b goes to a's group; a itself comes first in it
    wanted = pairs.unionByName(pairs.select("a", F.col("a").alias("b"))).distinct().groupBy("b").agg(
        F.collect_list("a").alias("to")).withColumnRenamed("b", "node")
    chosen = texts.join(wanted, "node").select("node", "to", "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in calls(batches, "text", CALL):
            a, b, tokens, held = [], [], [], 0
            sets = shingle_sets(batch.column(2).to_pylist(), k, hashes)
            for node, to, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets):
                raw = found.tobytes()
                if int.from_bytes(xxhash.xxh3_128_digest(raw)[:8], "little", signed=True) != node:
                    continue  # another text with the same hash
                for leader in to:
                    a.append(leader)
                    b.append(node)
                    tokens.append(raw)
                    held += len(raw)
                    if held > 4 * CALL:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tokens, pa.binary())],
                            names=["a", "b", "tokens"])
                        a, b, tokens, held = [], [], [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tokens, pa.binary())],
                names=["a", "b", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, head = None, np.zeros(0, dtype=np.uint64)
        for batch in calls(batches, "tokens", 4 * CALL):
            pa_, pb = [], []
            for a, b, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tokens = np.frombuffer(raw, np.uint64)
                if a == b:
                    leader, head = a, tokens
                elif a == leader:
                    at = np.searchsorted(head, tokens)
                    shared = int((head[np.minimum(at, len(head) - 1)] == tokens).sum())
                    if shared * 100 >= pct * (len(head) + len(tokens) - shared):
                        pa_.append(a)
                        pb.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(pa_, pa.int64()), pa.array(pb, pa.int64())], names=["a", "b"])

    dealt = chosen.mapInArrow(deal, "a bigint, b bigint, tokens binary").repartition("a").sortWithinPartitions(
        "a", (F.col("a") != F.col("b")), "b")
    return written(dealt.mapInArrow(compare, "a bigint, b bigint"), "verified", ROWS)


def _bits(combine) -> Column:
    """The ``bits`` of a group's rows, word by word."""
    return F.array(*[combine(F.col("bits")[i]) for i in range(BITS // 64)])


def _component_pairs(open_: DataFrame, pct: int) -> DataFrame:
    """(a, b), a < b: components with classes in one group that sizes and bits do not rule out, each pair once.

    A group holds, per component, the union of its classes' bits and what they all have: a bit that all classes
    of one have and the other's union lacks is a token in which every pair of their classes differs.
    """
    matrix = written(open_.groupBy("key", "root").agg(
        _bits(F.bit_or).alias("union"), _bits(F.bit_and).alias("core"), F.min("n").alias("least"), F.max("n").alias("most")),
        "matrix")
    side = lambda c: matrix.select("key", *[F.col(x).alias(f"{c}_{x}") for x in ("root", "union", "core", "least", "most")])
    differ = _missing(F.col("a_core"), F.col("b_union")) + _missing(F.col("b_core"), F.col("a_union"))
    return written(side("a").join(side("b"), "key").where(
        (F.col("a_root") < F.col("b_root"))
        & (F.col("a_most") * 100 >= F.col("b_least") * pct) & (F.col("b_most") * 100 >= F.col("a_least") * pct)
        & (differ <= F.floor((F.col("a_most") + F.col("b_most")) * (100 - pct) / (100 + pct)))
    ).select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "component-pairs")


def _candidates(pairs: DataFrame, members: DataFrame, pct: int) -> DataFrame:
    """(a, b): classes of component pairs; a class of the smaller one meets the larger one if its overlap with its union may do.

    Components of up to ``FEW`` classes are opened for it, larger ones are asked through :func:`_near_reference`.
    """
    of = members.groupBy("root").agg(_bits(F.bit_or).alias("union"), F.min("n").alias("least"), F.max("n").alias("most"),
                                     F.count("*").alias("size"))
    of = written(of, "component-sizes")
    size = lambda c: of.select(F.col("root").alias(c), F.col("size").alias(f"{c}_size"))
    first = F.col("a_size") <= F.col("b_size")
    sided = pairs.join(size("a"), "a").join(size("b"), "b").select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("small"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("large"))
    query = members.select(F.col("root").alias("small"), F.col("node").alias("q"), F.col("n").alias("q_n"), F.col("bits").alias("q_bits"))
    overlap = F.col("q_n") - _missing(F.col("q_bits"), F.col("union"))
    asked = written(sided.join(query, "small").join(of.withColumnRenamed("root", "large"), "large").where(
        (F.col("most") * 100 >= F.col("q_n") * pct) & (F.col("q_n") * 100 >= F.col("least") * pct)
        & (overlap * (100 + pct) >= (F.col("q_n") + F.col("least")) * pct)).select("large", "q", "q_n", "q_bits", "size"), "asked")
    large = members.withColumnRenamed("root", "large")
    few = asked.where(F.col("size") <= FEW).select("large", "q").join(large.select("large", "node"), "large").select("q", "node")
    many = asked.where(F.col("size") > FEW).drop("size").distinct()
    return few.unionByName(_near_reference(many, large, pct)).select(
        F.least("q", "node").alias("a"), F.greatest("q", "node").alias("b")).distinct()


def _places(bits: Column) -> Column:
    """The places of the set bits, in order."""
    return F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit(
        F.element_at(bits, F.shiftright(i, 6) + 1), i.bitwiseAND(63)) == 1)


def _near_reference(asked: DataFrame, large: DataFrame, pct: int) -> DataFrame:
    """(q, node): asked classes and the classes of their large component that bits do not rule out.

    The reference of a component is the bits that more than half of its classes have.  A set's deviation is what it
    has and the reference lacks, or the reverse; near copies have few.  With x and y deviations, s of them common,
    two sets differ in x + y - 2 s bits.  They may link if that is at most d, so s must be at least t = (x + y - d) / 2.
    If t is not positive, x and y say so alone.  Else the first x - t + 1 and y - t + 1 deviations, the rarest first,
    have one in common.  So classes meet only where they may link, and no product of components is made.
    """
    wanted = large.join(asked.select("large").distinct(), "large", "left_semi").select("large", "node", "n", _places(F.col("bits")).alias("at"))
    wanted = written(wanted, "large-members")
    half = wanted.groupBy("large").agg(F.count("*").alias("size"))
    usual = wanted.select("large", F.explode("at").alias("bit")).groupBy("large", "bit").agg(F.count("*").alias("n")).join(
        half, "large").where("2 * n > size").groupBy("large").agg(F.sort_array(F.collect_list("bit")).alias("usual"))
    reference = half.select("large").join(usual, "large", "left").select("large", F.coalesce("usual", F.array().cast("array<int>")).alias("usual"))
    reference = written(reference, "references")

    def deviating(df: DataFrame) -> DataFrame:
        out = F.concat(F.array_except("at", "usual"), F.array_except("usual", "at"))
        return df.join(reference, "large").withColumn("odd", out).drop("at", "usual").withColumn("x", F.size("odd"))

    of = written(deviating(wanted), "deviations")
    to = written(deviating(asked.select("large", F.col("q").alias("node"), F.col("q_n").alias("n"), _places(F.col("q_bits")).alias("at"))), "asked-deviations")
    often = written(of.select("large", F.explode("odd").alias("bit")).groupBy("large", "bit").agg(F.count("*").alias("often")), "bit-counts")
    most = lambda m, n: F.floor((m + n) * (100 - pct) / (100 + pct))
    widest = most(F.col("n"), F.floor(F.col("n") * 100 / pct))  # sizes of linked sets differ by pct at most

    def ranked(df: DataFrame) -> DataFrame:
        """(large, bit, node, n, x, nth), the deviations rarest first."""
        each = df.select("large", "node", "n", "x", F.explode("odd").alias("bit")).join(often, ["large", "bit"], "left")
        by = Window.partitionBy("large", "node").orderBy(F.coalesce("often", F.lit(0)), "bit")
        return each.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= F.col("x")).drop("often")

    side = lambda df, c: df.select("large", *[x for x in ("bit",) if x in df.columns], *[F.col(x).alias(f"{c}_{x}") for x in df.columns if x not in ("large", "bit")])
    # neither deviates much: every pair made is a candidate
    allowed = F.greatest(widest - F.col("x"), F.lit(-1)).cast("int")
    plain = side(of.where(F.col("x") <= widest).select("large", "node", "n", "x"), "l").withColumn("room", F.col("l_x")).join(
        side(to.where(allowed >= 0).select("large", "node", "n", "x", allowed.alias("allowed")), "q").select(
            "*", F.explode(F.sequence(F.lit(0), F.col("q_allowed"))).alias("room")), ["large", "room"])
    least = F.ceil((F.col("l_x") + F.col("q_x") - most(F.col("l_n"), F.col("q_n"))) / 2)
    shared = side(ranked(of), "l").join(side(ranked(to), "q"), ["large", "bit"]).where(
        (least > 0) & (F.col("l_nth") <= F.col("l_x") - least + 1) & (F.col("q_nth") <= F.col("q_x") - least + 1))
    return plain.where(least <= 0).select(F.col("q_node").alias("q"), F.col("l_node").alias("node")).unionByName(
        shared.select(F.col("q_node").alias("q"), F.col("l_node").alias("node")))


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the root of their component (their own node without links)."""
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, pct: int = 80,
            rounds: int = 3) -> DataFrame:
    """(id, text_hash, n, node, component): every document's set size, class and component (its smallest id).

    ``k`` words make a shingle; sets link when 100 |a and b| >= pct |a or b|.
    ``rounds`` of contraction come before the matrix; they change the work, not the result: with none, every link
    comes through the matrix.
    """
    rows = written(_signatures(docs, id_col, text_col, k), "signatures", 4 * ROWS)
    by_node = rows.where("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"),
        F.min("digest").alias("d0"), F.max("digest").alias("d1"))
    names = written(by_node.select("node", "first.id", "first.text_hash", "d0", "d1"), "classes")
    if names.where("d0 <> d1").limit(1).count():
        raise ValueError("two sets share a 64-bit node")
    sets = written(rows.where("bits is not null").select("node", "n", "bits", "parity").dropDuplicates(["node"]), "sets")

    # the largest table here by far: dealt by key once, for the groups and for their members
    index = _index(docs, text_col, k, pct).repartition("key")
    shared = index.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = written(index.join(shared.select("key"), "key").select("node", "key").distinct(), "members")
    texts = written(_candidate_texts(docs, names, members.select("node").distinct(), id_col, text_col), "texts")

    open_, roots = members.withColumn("root", F.col("node")), None
    for turn in range(rounds):
        first = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")).alias("head")
        stars = open_.join(open_.groupBy("key").agg(first), "key").where("root <> head.root").select(
            F.col("head.node").alias("a"), F.col("node").alias("b")).groupBy("a", "b").agg(F.count("*").alias("agreed"))
        links = _linked(_nearest(_plausible(stars, sets, pct)), texts, k, pct)
        if roots is not None and links.isEmpty():
            break
        edges = links if roots is None else links.unionByName(
            roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = written(components(edges), "roots")
        placed = _rooted(members.select("key", "node"), roots)
        several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        open_ = written(placed.join(several.select("key"), "key", "left_semi"), "open")

    # groups with the very same classes repeat each other's pairs: one of them is enough
    alike = open_.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                     F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    open_ = open_.join(alike.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")
    open_ = written(open_.join(sets.drop("parity"), "node"), "open")
    rest = _candidates(_component_pairs(open_, pct), open_.select("node", "root", "n", "bits").dropDuplicates(["node"]), pct)
    more = _linked(_plausible(rest, sets, pct), texts, k, pct)
    edges = more if roots is None else more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = written(components(edges), "roots")

    labelled = _rooted(names.select("node", "id"), joined)
    smallest = labelled.groupBy("root").agg(F.min("id").alias("component"))
    label = labelled.join(smallest, "root").select("node", "component")
    return rows.select("id", "text_hash", "n", "node").join(label, "node", "left").select(
        "id", "text_hash", "n", "node", F.coalesce("component", "id").alias("component"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component: the one with the smallest id (of repeated rows, one); same columns.

    Documents without a set stay.
    """
    found = classes(docs, id_col, text_col, **options)
    first = found.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("f"))
    stay = written(first.select("f.id", "f.text_hash").unionByName(found.where("n = 0").select("id", "text_hash"))
                   .distinct(), "stay")
    boxed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"),
                        F.xxhash64(docs[text_col]).alias("text_hash"))
    return boxed.join(stay, boxed["id"].eqNullSafe(stay["id"]) & (boxed["text_hash"] == stay["text_hash"]), "left_semi"
                      ).dropDuplicates(["id", "text_hash"]).select("row.*")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    return classes(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
