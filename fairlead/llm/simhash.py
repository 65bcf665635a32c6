"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint's 64 bits are grouped into partitions, correlated bits together. If two fingerprints differ in at most ``tau`` bits, then for any thresholds t_i >= -1 with sum tau - m + 1 over the m partitions some partition differs in at most t_i bits (-1: never). The number of partitions follows from the number of fingerprints; the thresholds are allocated by dynamic programming on candidate counts estimated from the partitions' value counts over all fingerprints. Every fingerprint is indexed by its partition values and probes those within t_i; what meets at a value is verified on all bits, by whole arrays.

Links are returned as those that connect what each value brings together, at most one a fingerprint and value, so a group of thousands of near copies does not become millions of pairs. Values that more than ``BLOCK`` fingerprints share are crowds. With tau of 2 or less what belongs to one is linked exactly another way: each fingerprint lists the 65 points within one bit of it, and two are within two bits if and only if they list a common point; at most 65 fingerprints list any point, and each is linked to the point's smallest. For greater tau a crowd is compared in blocks dealt over tasks. Nothing is dropped.

Copies share a fingerprint and are one node from the start; links join nodes, components come from ``graph.components``, and documents get them back by a join that broadcasts hot fingerprints.

Near-dedup (``near_dedup``) goes the same way, with fingerprints over distinct shingles and within ``TAU`` bits; what that connects is compared exactly by whole shingle sets. Texts may be as similar as asked and yet differ in more bits, so texts that the pigeonhole leaves apart are candidates too if they share a band of minimum hashes.

Defined results: a null or empty text, or one without words, has fingerprint 0 and is linked like any other. Fewer words than a shingle: the whole sequence is one. Null ids are fingerprinted and linked; a component's id is its smallest id that is not null. Repeated rows are rows. Extra columns are ignored (``components_of``) or kept (``near_dedup``). Empty tables give empty results. Texts of any length are hashed in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, free_name, join_labels, map_groups, map_rows, materialize, skew_join
from .graph import components

SHINGLE = 3
SEED = 42
TAU = 2
#: Fingerprints of one value that are compared in one task.
BLOCK = 4096
#: Cost of one probe row (shuffled, sorted), in compared pairs.
PROBE_COST = 200

_PIECE = 1 << 20


def word_pieces(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words of ``data`` in pieces, each after the first starting with the last ``overlap`` words before it. Pieces end at white space."""
    if len(data) <= _PIECE:
        yield data.split()
        return
    at, carry = 0, []
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and data[end : end + 1] not in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"):
            end += 1
        words = carry + data[at:end].split()
        at = end
        yield words
        carry = words[-overlap:] if overlap else []


def shingle_hashes(text: str | None, k: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the k-word shingles, in pieces."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    seen = False
    words: list[bytes] = []
    for words in word_pieces(data, k - 1):
        n = len(words) - k + 1
        if n > 0:
            seen = True
            parts = map(b" ".join, zip(*[words[i:] for i in range(k)], strict=False)) if k > 1 else words
            yield np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), dtype=np.uint64, count=n)
    if not seen and words:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set. Bits are summed as bytes, eight to a 64-bit lane, 255 rows at a time."""
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 255 * 128):
        part = hashes[i : i + 255 * 128]
        lanes = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        full = len(part) // 255
        if full:
            total += lanes[: full * 255].reshape(full, 255, 8).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(full, 64).sum(axis=0, dtype=np.int64)
        total += lanes[full * 255 :].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return total


def majority(pieces: Iterator[np.ndarray]) -> int:
    """The fingerprint, as a signed number: bits set in more than half of the hashes."""
    count, n = np.zeros(64, dtype=np.int64), 0
    for h in pieces:
        count += bit_counts(h)
        n += len(h)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""
    return map_rows(docs, text_col, [T.StructField(out, T.LongType())], lambda: lambda texts: {out: [majority(shingle_hashes(t, shingle, seed)) for t in texts]})


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ball(width: int, t: int) -> int:
    return sum(math.comb(width, j) for j in range(t + 1)) if t >= 0 else 0


def correlation(nodes: DataFrame) -> np.ndarray:
    """|correlation| of each two bits over all nodes: every task sums up 64 x 64 counts, the driver gets 2,080 sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        n = 0
        for b in batches:
            bits = np.unpackbits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.triu_indices(64)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i * 64 + j, -1)), pa.array(np.append(total[i, j], n).astype(np.int64))], names=["cell", "n"])

    cells = nodes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    got = {r["cell"]: r["n"] for r in cells}
    n = got.pop(-1, 0)
    both = np.zeros((64, 64))
    for c, x in got.items():
        both[c // 64, c % 64] = both[c % 64, c // 64] = x
    if not n:
        return np.eye(64)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd))


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of nearly equal width, each grown around a bit by taking the free bit most correlated with it so far."""
    free, parts = list(range(64)), []
    for k in range(m):
        width = -(-len(free) // (m - k))
        part = [max(free, key=lambda b: (float(corr[b][free].sum()), -b))]
        free.remove(part[0])
        while len(part) < width:
            best = max(free, key=lambda b: (float(corr[b][part].sum()), -b))
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def allocate(tau: int, widths: list[int], n: int, same: list[float]) -> list[int]:
    """Thresholds of least cost with sum tau - m + 1, by dynamic programming. ``same``: pairs that agree in the partition's value; a probe of a neighbouring value is taken to meet as many as one of the own."""
    cost = lambda i, t: 0.0 if t < 0 else ball(widths[i], t) * (PROBE_COST * float(n) + same[i])
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(widths)):
        after: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t in range(-1, min(tau, widths[i]) + 1):
                x = c + cost(i, t)
                if s + t not in after or x < after[s + t][0]:
                    after[s + t] = (x, [*ts, t])
        best = after
    return best[tau - len(widths) + 1][1]


def count_of_partitions(tau: int, n: int) -> int:
    """The number of partitions of least cost if bits were even and independent."""

    def cost(m: int) -> float:
        widths = [64 // m] * m
        same = n * n / 2 / 2.0 ** (64 // m)
        return sum(ball(64 // m, t) * (PROBE_COST * n + same) for t in allocate(tau, widths, n, [same] * m) if t >= 0)

    return min(range(1, tau + 2), key=cost)


def _key(fp: Column, part: list[int]) -> Column:
    out = F.lit(0).cast("long")
    for j, b in enumerate(part):
        out = out + F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1)), j)
    return out


def _masks(width: int, t: int) -> list[int]:
    return [sum(1 << b for b in c) for j in range(t + 1) for c in combinations(range(width), j)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _links_of_groups(tau: int, more: list[str], most: int | None):
    """Makes links out of groups of rows (role: 0 found, 1 finding, 2 both): within ``tau`` bits, and if ``most`` is given within that many bits over the ``more`` columns together."""

    def fn(whole: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        ends = np.append(starts[1:], whole.num_rows)
        fp, role = whole.column("fp").to_numpy().view(np.uint64), whole.column("role").to_numpy()
        name = whole.column("name").to_numpy()
        extra = [whole.column(c).to_numpy().view(np.uint64) for c in more]
        us, vs = [], []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            finds, found = s + np.flatnonzero(role[s:e] >= 1), s + np.flatnonzero(role[s:e] != 1)
            _, same = np.unique(name[s:e], return_inverse=True)
            first = np.full(same.max() + 1, e - s, dtype=np.int64)
            np.minimum.at(first, same, np.arange(e - s))
            labels = np.arange(e - s)
            for i in range(0, len(finds), 512):
                part = finds[i : i + 512]
                x, y = np.nonzero(np.bitwise_count(fp[part, None] ^ fp[None, found]) <= tau)
                x, y = part[x], found[y]
                if most is not None and len(x):
                    near = sum(np.bitwise_count(c[x] ^ c[y]).astype(np.int64) for c in extra) <= most
                    x, y = x[near], y[near]
                labels = join_labels(labels, first[same[x - s]], first[same[y - s]])
            moved = np.flatnonzero((labels != np.arange(e - s)) & (first[same] == np.arange(e - s)))
            us.append(labels[moved] + s)
            vs.append(moved + s)
        if not us or not sum(map(len, us)):
            return None
        node = whole.column("node")
        return pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(z))).combine_chunks() for z in (us, vs)], names=["u", "v"])

    return fn


def _in_blocks(keyed: DataFrame) -> DataFrame:
    """Rows with ``_part``, those of crowds (with ``_blocks``) dealt out: what is found lies in one block by hash; what finds goes to every block."""
    crowded = F.col("_blocks").isNotNull()
    alone = keyed.filter(~crowded).withColumn("_part", F.lit(0))
    found = keyed.filter(crowded & (F.col("role") != 1)).withColumns({"role": F.lit(0).cast("byte"), "_part": F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")})
    finds = keyed.filter(crowded & (F.col("role") != 0)).withColumns({"role": F.lit(1).cast("byte"), "_part": F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))})
    return alone.unionByName(found).unionByName(finds)


def close_links(nodes: DataFrame, tau: int, *, more: list[str] | None = None, most: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links (u, v) among nodes (node, fp, *more), each within ``tau`` bits or connected by such, that have the same components as all pairs within ``tau`` bits. ``most`` bounds the bits over the ``more`` columns too. ``nodes`` must be materialised."""
    more = more or []
    n = nodes.count()
    m = count_of_partitions(tau, max(n, 2))
    parts = group_bits(correlation(nodes), m)
    keyed = nodes.select("node", "fp", *more, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _key(F.col("fp"), p).alias("key")) for i, p in enumerate(parts)])).alias("_x")).select("node", "fp", *more, "_x.i", "_x.key")
    values = materialize(keyed.groupBy("i", "key").agg(F.count("*").alias("_w")), "values")
    same = {r["i"]: float(r["s"]) for r in values.groupBy("i").agg(F.sum(F.col("_w").cast("double") * (F.col("_w") - 1) / 2).alias("s")).collect()}
    ts = allocate(tau, [len(p) for p in parts], n, [same.get(i, 0.0) for i in range(m)])
    used = [i for i in range(m) if ts[i] >= 0]
    flipped = [i for i in used if ts[i] > 0]
    keyed = keyed.filter(F.col("i").isin(used)).withColumn("role", F.when(F.col("i").isin(flipped), 0).otherwise(2).cast("byte"))
    if flipped:
        masks = F.create_map(*[x for i in flipped for x in (F.lit(i), F.lit(_masks(len(parts[i]), ts[i])).cast("array<bigint>"))])
        probes = keyed.filter(F.col("i").isin(flipped)).withColumns({"role": F.lit(1).cast("byte"), "key": F.explode(F.transform(F.element_at(masks, F.col("i")), lambda x: x.bitwiseXOR(F.col("key"))))})
        keyed = keyed.unionByName(probes)
    crowds = materialize(values.filter((F.col("_w") > block) & F.col("i").isin(used)).withColumn("_blocks", F.ceil(F.col("_w") / block).cast("int")), "crowds")
    extra = None
    group = F.xxhash64("i", "key")
    if not crowds.isEmpty():
        keyed = skew_join(keyed, crowds, ["i", "key"], "_w")
        crowded = F.col("_blocks").isNotNull()
        if tau <= 2:
            extra = _ball_links(materialize(keyed.filter(crowded).select("node", "fp").distinct(), "crowded"))
            keyed = keyed.filter(~crowded)
        else:
            keyed = _in_blocks(keyed)
            group = F.xxhash64("i", "key", "_part")
    dealt = keyed.select(group.alias("_g"), "node", F.xxhash64("node").alias("name"), "fp", "role", *more)
    kind = nodes.schema["node"].dataType.simpleString()
    links = map_groups(dealt, "_g", _links_of_groups(tau, more, most), f"u {kind}, v {kind}")
    return links if extra is None else links.unionByName(extra)


def _ball_links(members: DataFrame) -> DataFrame:
    """Links among (node, fp), distinct fingerprints, that connect all within two bits: by each point within one bit of two or more, to its smallest member."""
    points = F.transform(F.lit([0, *[_signed(1 << b) for b in range(64)]]).cast("array<bigint>"), lambda x: x.bitwiseXOR(F.col("fp")))
    listed = members.select("node", F.explode(points).alias("point"))
    met = listed.groupBy("point").agg(F.collect_set("node").alias("all")).filter(F.size("all") > 1)
    return met.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).filter("u < v").distinct()


def components_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable over links of at most ``tau`` bits."""
    prints = materialize(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle=shingle, seed=seed).select("doc_id", "fp"), "prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("_w")).withColumn("node", F.col("fp")), "nodes")
    roots = components(close_links(nodes.select("node", "fp"), tau, block=block))
    rooted = materialize(nodes.join(roots, "node", "left").select("fp", "first", "_w", F.coalesce("root", "node").alias("root")), "rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("_n")), "least")
    named = materialize(skew_join(rooted, least, "root", "_n").select("fp", "component_id", "_w"), "named")
    return skew_join(prints, named, "fp", "_w").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


#: Near copies: five-word shingles and this Jaccard similarity; candidates have fingerprints over distinct shingles within so many bits, or share a band of minimum hashes, which a pair that similar fails to do at most so often.
NEAR_SHINGLE = 5
SIMILARITY = 0.8
MISS = 1e-5
#: Nodes whose shingle sets are compared in one task, and shingles in all of these together.
FAMILY = 256
FAMILY_SHINGLES = 500_000
#: Nodes that stand for a class when classes of one large group are compared.
LEADERS = 16
_SKETCH = 256

_NEAR = [T.StructField("n_shingles", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), *[T.StructField(f"s{i}", T.LongType()) for i in range(_SKETCH // 64)]]


def band_rows(similarity: float) -> int:
    """The most minimum hashes a band can have so that a pair this similar shares none of the bands at most ``MISS`` of the time."""
    return max((r for r in range(1, 17) if (1 - similarity**r) ** (_SKETCH // r) <= MISS), default=1)


class NearPrints:
    """Of a text the size of its shingle set, its fingerprint, and from 256 minimum hashes of it a key for each band of them and a sketch, a bit of each. A minimum hash of two sets with Jaccard similarity s is the same with chance s, so their sketches differ in (1 - s) / 2 of their bits on average."""

    def __init__(self, shingle: int, rows: int) -> None:
        rng = np.random.default_rng(11)
        self.shingle = shingle
        self.rows = rows
        self.mul = (rng.integers(0, 2**32, _SKETCH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.add = rng.integers(0, 2**32, _SKETCH, dtype=np.uint64).astype(np.uint32)
        self.fold = rng.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def lowest(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(_SKETCH, 0xFFFFFFFF, dtype=np.uint32)
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(small), 512):
            np.minimum(low, (small[i : i + 512, None] * self.mul + self.add).min(axis=0), out=low)
        return low

    def sketch(self, low: np.ndarray) -> list[int]:
        bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(bool)
        return np.packbits(bits, bitorder="little").view(np.int64).tolist()

    def bands(self, low: np.ndarray) -> list[int]:
        whole = low[: _SKETCH // self.rows * self.rows].reshape(-1, self.rows).astype(np.uint64)
        return (whole * self.fold).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()

    def __call__(self, text: str | None) -> list:
        sets = [np.unique(h) for h in shingle_hashes(text, self.shingle)]
        if not sets:
            return [0, 0, [], *[0] * (_SKETCH // 64)]
        shingles = np.unique(np.concatenate(sets))
        low = self.lowest(shingles)
        return [len(shingles), majority(iter([shingles])), self.bands(low), *self.sketch(low)]


def shingle_set(text: str | None, k: int) -> list[int]:
    parts = [np.unique(h) for h in shingle_hashes(text, k)]
    return np.unique(np.concatenate(parts)).view(np.int64).tolist() if parts else []


def most_sketch_bits(similarity: float) -> int:
    """Bits that the sketches of a pair this similar exceed about once in 30,000 times."""
    p = (1 - similarity) / 2
    return math.ceil(_SKETCH * p + 4 * math.sqrt(_SKETCH * p * (1 - p)))


def _similar_in_groups(similarity: float):
    """Makes links out of groups of rows (node, role, set): pairs whose sets have at least this Jaccard similarity, of which at least one finds (role 1 or 2) and the other is found (0 or 2). For each finding set, the lists of those that share its members are counted."""

    def fn(whole: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        ends = np.append(starts[1:], whole.num_rows)
        sets, role = whole.column("set").combine_chunks(), whole.column("role").to_numpy()
        offsets, values = sets.offsets.to_numpy(), sets.values.to_numpy()
        us, vs = [], []
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            size = np.diff(offsets[s : e + 1])
            _, member = np.unique(values[offsets[s] : offsets[e]], return_inverse=True)
            owner = np.repeat(np.arange(e - s), size)
            order = np.argsort(member, kind="stable")
            lists, first = owner[order], np.searchsorted(member[order], np.arange(member.max() + 2 if len(member) else 1))
            length, at = np.diff(first), offsets[s : e + 1] - offsets[s]
            labels = np.arange(e - s)
            found = role[s:e] != 1
            for i in np.flatnonzero(role[s:e] != 0).tolist():
                shared = np.zeros(e - s, dtype=np.int64)
                for j in range(at[i], at[i + 1], 1024):
                    own = member[j : min(j + 1024, at[i + 1])]
                    n = length[own]
                    reach = np.repeat(first[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    shared += np.bincount(lists[reach], minlength=e - s)
                near = np.flatnonzero(found & (shared >= similarity * (size[i] + size - shared)))
                near = near[labels[near] != labels[i]]
                if len(near):
                    labels = join_labels(labels, np.full(len(near), i), near)
            moved = np.flatnonzero(labels != np.arange(e - s))
            us.append(labels[moved] + s)
            vs.append(moved + s)
        if not us or not sum(map(len, us)):
            return None
        node = whole.column("node")
        return pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(z))).combine_chunks() for z in (us, vs)], names=["u", "v"])

    return fn


def connect(members: DataFrame, payload: DataFrame, fn, kind: str, *, most: int, known: DataFrame | None = None) -> DataFrame:
    """Links (u, v) that connect, within each group of ``members`` (group, node, parts; materialised), what all links that ``fn`` finds in it would connect. ``payload`` has what ``fn`` compares, by node. ``known``: links (u, v) that hold already and are returned too.

    A group of one part is compared whole. In a larger one first the parts are, each by itself, which joins most of a crowd of like nodes to few classes; then some nodes of each class with those of the others; and at last all that is not in the group's largest class with all of the group. So every pair of nodes that are not connected by then has been compared, but a crowd in which most are alike costs in proportion to its size and not to the square of it.
    """

    def links(dealt: DataFrame) -> DataFrame:
        return map_groups(dealt.join(payload, "node"), "_g", fn, f"u {kind}, v {kind}")

    def role(r: int):
        return F.lit(r).cast("byte").alias("role")

    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    found = links(members.select(F.when(F.col("parts") == 1, F.col("group")).otherwise(F.xxhash64("group", part)).alias("_g"), "node", role(2)))
    found = found if known is None else found.unionByName(known)
    many = members.filter("parts > 1")
    if many.isEmpty():
        return found
    found = materialize(found, "found")

    def classes() -> tuple[DataFrame, DataFrame]:
        """Large groups' members with their class, and of groups with several classes (group, largest, others)."""
        classed = materialize(many.join(components(found), "node", "left").select("group", "node", "parts", F.coalesce("root", "node").alias("class")), "classed")
        sizes = classed.groupBy("group", "class").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("class", F.struct("n", "class")).alias("largest"), (F.sum("n") - F.max("n")).alias("others"), F.sum("n").alias("_w"))
        return classed, materialize(sizes.filter("others > 0"), "several")

    classed, several = classes()
    if several.isEmpty():
        return found
    some = skew_join(classed, several.select("group", "_w"), "group", "_w", "inner").groupBy("group", "class", F.pmod(F.xxhash64("node"), F.lit(LEADERS)).alias("_s")).agg(F.min("node").alias("node"))
    some = materialize(some.select("group", "node"), "leaders")
    dealt = materialize(some.groupBy("group").agg(F.count("*").alias("_w"), F.ceil(F.count("*") / most).cast("int").alias("parts")), "dealt")
    # Two parts meet in the group of their smaller and greater number.
    met = skew_join(some, dealt, "group", "_w", "inner").withColumn("_a", part).withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = materialize(found.unionByName(links(met.select(F.xxhash64("group", F.least("_a", "_b"), F.greatest("_a", "_b")).alias("_g"), "node", role(2)))), "found")
    classed, several = classes()
    if several.isEmpty():
        return found
    spread = several.select("group", "largest", F.ceil(F.col("others") / most).cast("int").alias("blocks"), "_w")
    left = skew_join(classed, spread, "group", "_w", "inner")
    # A block of the others meets each part of all.
    every = left.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(F.xxhash64("group", part, "_b").alias("_g"), "node", role(0))
    block = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int")
    others = left.filter(F.col("class") != F.col("largest")).withColumn("_a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(F.xxhash64("group", "_a", block).alias("_g"), "node", role(1))
    return materialize(found.unionByName(links(every.unionByName(others))), "found")


def _verified(keyed: DataFrame, nodes: DataFrame, families: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (u, v) that connect the nodes of each family (node, root) whose shingle sets, compared whole, are similar. A task holds about ``FAMILY`` nodes or ``FAMILY_SHINGLES``, at most twice."""
    many = F.ceil(F.greatest(F.count("*") / FAMILY, F.sum("n_shingles") / FAMILY_SHINGLES))
    sizes = materialize(families.join(nodes.select("node", "n_shingles"), "node").groupBy("root").agg(F.count("*").alias("_w"), F.greatest(F.lit(1), many).cast("int").alias("parts")), "families")
    members = materialize(skew_join(families, sizes, "root", "_w").select(F.xxhash64("root").alias("group"), "node", "parts"), "members")
    wanted = families.select("node").join(nodes.select("node", "first"), "node")
    rows = keyed.join(wanted, (keyed["node"] == wanted["node"]) & keyed["id"].eqNullSafe(wanted["first"])).select(keyed["node"], "text").dropDuplicates(["node"])
    field = T.StructField("set", T.ArrayType(T.LongType()))
    sets = materialize(map_rows(rows, "text", [field], lambda: lambda texts: {"set": [shingle_set(t, shingle) for t in texts]}).drop("text"), "sets")
    return connect(members, sets, _similar_in_groups(similarity), "binary", most=FAMILY)


def print_links(nodes: DataFrame, *, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that connect the nodes (node, fp) whose fingerprints differ in at most ``tau`` bits: equal ones to their smallest node, those by the pigeonhole. ``nodes`` must be materialised."""
    firsts = materialize(nodes.groupBy("fp").agg(F.min("node").alias("u"), F.count("*").alias("_w")), "firsts")
    equal = skew_join(nodes.select("node", "fp"), firsts.filter("_w > 1"), "fp", "_w", "inner").select("u", F.col("node").alias("v")).filter("u < v")
    return equal.unionByName(close_links(firsts.select(F.col("u").alias("node"), "fp"), tau, block=block))


def band_links(nodes: DataFrame, close: DataFrame, most: int, *, block: int = BLOCK) -> DataFrame:
    """``close`` links (u, v) and those that connect, beyond them, the nodes (node, bands, s0...) that share a band and whose sketches differ in at most ``most`` bits. A band whose nodes ``close`` connects already is not looked at. Both must be materialised."""
    # No part of the sketch can differ in more bits than the whole: the first one is looked at before the others.
    more = ["fp", *[f"s{i}" for i in range(1, _SKETCH // 64)]]
    sketches = nodes.select("node", F.xxhash64("node").alias("name"), F.col("s0").alias("fp"), *more[1:])
    # Most bands are of one class only: they are told by their hash alone before nodes travel.
    rooted = nodes.select("node", "bands").join(components(close), "node", "left").select(F.xxhash64(F.coalesce("root", "node")).alias("class"), F.posexplode("bands").alias("i", "key"))
    apart = rooted.groupBy(F.xxhash64("i", "key").alias("group")).agg(F.count("*").alias("_w"), F.min("class").alias("_a"), F.max("class").alias("_b")).filter("_a < _b")
    shared = materialize(apart.select("group", "_w", F.ceil(F.col("_w") / block).cast("int").alias("parts")), "shared")
    keyed = nodes.select("node", F.posexplode("bands").alias("i", "key")).select("node", F.xxhash64("i", "key").alias("group"))
    members = materialize(skew_join(keyed, shared, "group", "_w", "inner").select("group", "node", "parts"), "members")
    kind = nodes.schema["node"].dataType.simpleString()
    return connect(members, sketches, _links_of_groups(most, more, most), kind, most=block, known=close)


def near_classes(docs: DataFrame, *, shingle: int = NEAR_SHINGLE, similarity: float = SIMILARITY, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """From docs (id, text): the prints (id, node), and (node, id) of the one document of each class that stays. A node is a text by its MD5 (texts without words are one node)."""
    worded = F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    keyed = docs.select("id", "text", F.when(worded, F.unhex(F.md5("text"))).otherwise(F.lit(b"")).alias("node"))

    def make():
        prints = NearPrints(shingle, band_rows(similarity))
        return lambda texts: {f.name: list(x) for f, x in zip(_NEAR, zip(*map(prints, texts), strict=True), strict=True)} if texts else {f.name: [] for f in _NEAR}

    names = [f.name for f in _NEAR]
    prints = materialize(map_rows(keyed, "text", _NEAR, make).drop("text"), "prints")
    nodes = materialize(prints.groupBy("node").agg(*[F.first(c).alias(c) for c in names], F.min("id").alias("first")), "nodes")
    most = most_sketch_bits(similarity)
    close = materialize(print_links(nodes, block=block), "close")
    likely = materialize(band_links(nodes, close, most, block=block), "likely")
    linked = materialize(components(likely), "linked")
    families = linked.select("node", "root").unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    links = _verified(keyed, nodes, families, shingle, similarity)
    roots = components(links)
    rooted = materialize(nodes.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "rooted")
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("k")).select(F.col("k.node").alias("node"), F.col("k.first").alias("id"))
    return prints.select("id", "node"), kept


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document, the one with the smallest id, of each class of exact and near copies. Repeated rows count as copies. Columns stay as they are."""
    names = [free_name(docs.columns, f"_c{i}") for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    a, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    prints, kept = near_classes(own.select(F.col(a).alias("id"), F.col(text).alias("text")), **options)
    kept = materialize(kept, "kept")
    node = F.when(F.rlike(own[text], F.lit(r"[^\x20\x09-\x0D]")), F.unhex(F.md5(own[text]))).otherwise(F.lit(b""))
    left = own.join(kept, own[a].eqNullSafe(kept["id"]) & (node == kept["node"]), "left_semi")
    if not prints.groupBy("id", "node").count().filter("count > 1").isEmpty():
        left = left.withColumn("_node", node).dropDuplicates([a, "_node"]).drop("_node")
    return left.toDF(*docs.columns)
