"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidate edges.

1. Signatures (Arrow batches): words, distinct shingles of `shingle` words hashed to 64 bits, one permutation split
   into bands*rows bins; an empty bin takes the minimum of the bin that a fixed hash sequence of (bin, attempt) leads
   to first. A band of `rows` bins makes a bucket key. With 28 bands of 4 rows a pair of similarity 0.8 meets in no
   bucket with probability 4e-7, and one of 0.9 practically never.
2. Documents with equal shingle sets form classes (aggregate combined before the shuffle); only the representative goes
   on, so copies never meet in a bucket. A Bloom filter of the shared sets spares the others the join.
3. One aggregate over (key, id) names each bucket's centre, its smallest id, and settles buckets of two. Each other
   member has one edge to its centre: as many edges as members, never all pairs. Only members of buckets of three or
   more (told by another Bloom filter) are shuffled a second time.
4. An edge goes on if the sizes allow the similarity and the ends' sketches (four bits a bin) are not six deviations
   below it. Texts are read for the ends that are left and held against the centre's, a centre's text once for each
   CROWD of its edges; sets are compared in full. Links give components.
5. What is left is settled without centres: every two members of a bucket that are in different components are
   compared. Members are dealt into units by the family they belong to (the largest bucket that overlaps their own
   largest one), of about UNIT members or WEIGHT shingles; two units that meet in a bucket are one group, so two
   documents that meet in many buckets are compared once. A group first tells far pairs by sketches; texts are read only
   for members with a pair left, whose sets are compared in full. So no link between two texts that share a bucket is
   left to the choice of centres. The pairs of a family of many texts just under the cutoff are many by nature: work
   there is quadratic, rows are quadratic over UNIT, and no row is made per pair.

Cases: null and empty texts have no shingles and are linked with nothing; a text with fewer words than a shingle is
one shingle; rows with a null id are reported with their own null component and kept; repeated rows are one class;
rows that share an id but not their text are judged each by its own text (and stay or go together in
`drop_near_copies`, which drops an id only if none of its rows is kept); other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MOST_BLOCKS, bloom_blocks, bloom_probe, bloom_table, cut, drop, forget_others, remember, table
from .graph import components

BANDS, ROWS = 28, 4
#: Deviations that the sketches of a pair may be off; the deviation is that of as many draws as the smaller set fills bins.
DEVIATIONS = 6.0
#: Edges of a centre that are confirmed together.
CROWD = 256
#: Members of a unit, and shingles of a unit.
UNIT, WEIGHT = 1024, 200_000
#: Shingles that one matrix product covers, and pairs whose sketches are compared at once.
BLOCK = 4096
PAIRS = 1 << 18
#: Rows of numbers that may be broadcast: some 10 MB.
SMALL_ROWS = 1 << 18
CACHE_WORDS = 300_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_HASHES: dict[str, int] = remember("near_dedup")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NIBBLES = 0x1111111111111111


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser for 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower() if text.isascii() else text.translate(_LOWER)
    return _WORD.findall(text)


def _word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    h = _HASHES
    if len(h) > CACHE_WORDS:
        h.clear()
    for w in set(words).difference(h):
        h[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(h.__getitem__, words), np.uint64, len(words))


def shingles_of(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = _word_hashes(words)
    n = max(1, len(h) - size + 1)
    acc = np.full(n, len(h) if len(h) < size else size, np.uint64)
    for i in range(min(size, len(h))):
        acc = mix(acc * _M1 + h[i : i + n] * _M2 + np.uint64(i))
    return np.unique(acc)


class Signer:
    """Signatures of one-permutation hashing with optimal densification."""

    def __init__(self, bands: int, rows: int, seed: int = 1, attempts: int = 64) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        grid = np.arange(self.bins, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(attempts, dtype=np.uint64)
        self.go = (mix(grid + np.uint64(seed) * _M1) % np.uint64(self.bins)).astype(np.int64)

    def sign(self, s: np.ndarray) -> np.ndarray:
        p = mix(s ^ _M2)
        at = ((p >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        sig = np.full(self.bins, np.uint64(0xFFFFFFFFFFFFFFFF))
        np.minimum.at(sig, at, p)
        full = np.zeros(self.bins, bool)
        full[at] = True
        if not full.all():
            empty = np.flatnonzero(~full)
            hit = full[self.go[empty]]
            first = hit.argmax(1)
            src = np.where(hit.any(1), self.go[empty, first], np.flatnonzero(full)[0])
            sig[empty] = sig[src]
        return sig

    def keys(self, sig: np.ndarray) -> np.ndarray:
        m = sig.reshape(self.bands, self.rows)
        acc = np.arange(self.bands, dtype=np.uint64) + np.uint64(1)
        for r in range(self.rows):
            acc = mix(acc * _M1 + m[:, r])
        return acc.view(np.int64)

    def sketch(self, sig: np.ndarray) -> np.ndarray:
        """Four bits a bin, sixteen bins a word."""
        x = mix(sig + np.arange(self.bins, dtype=np.uint64) * _M2) & np.uint64(15)
        x = np.pad(x, (0, -self.bins % 16)).reshape(-1, 16)
        return np.bitwise_or.reduce(x << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1).view(np.int64)


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set), keys (one a band), sketch (words of sixteen bins)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        forget_others("near_dedup")
        signer = Signer(bands, rows)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                s = shingles_of(text, shingle)
                if len(s):
                    sig = signer.sign(s)
                    out.append((doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), signer.keys(sig), signer.sketch(sig)))
                else:
                    out.append((doc, 0, None, None, None))
            res = pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_key", "keys", "sketch"])
            res["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in res["doc_id"]], "Int64")
            yield res

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInPandas(run, "doc_id long, n_shingles long, set_key binary, keys array<long>, sketch array<long>")


def _maybe_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among the distinct ids, and a few others: what a Bloom filter of bounded size lets through,
    without a shuffle. With more ids than it can tell apart an exact join follows (an inner one, as a semi-join would be
    pushed below the filter)."""
    n = ids.count()
    if n == 0:
        return rows.limit(0)
    blocks = bloom_blocks(n)
    bloom = bloom_table(ids, F.col(key), blocks).select(F.col("block").alias("_block"), F.col("word").alias("_word"))
    block, bits = bloom_probe(F.col(key), blocks)
    some = rows.select("*", block.alias("_block"), bits.alias("_bits")).join(F.broadcast(bloom), "_block")
    some = some.where(F.col("_word").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*rows.columns)
    return some if n <= 4 * MOST_BLOCKS else some.join(ids.select(key), key).select(*rows.columns)


def _small(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most SMALL_ROWS rows of a few numbers."""
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of these ids, and a few others."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return cut(_maybe_among(src, ids, "doc_id"), "texts")


def _off(same: float, bins: int) -> float:
    """Sketch positions in which a pair of this similarity differs on average."""
    return bins * (1 - same) * 15 / 16


def near_enough(x: str, y: str, nx: str, ny: str, percent: int, bins: int) -> Column:
    """Whether sizes and sketches leave the similarity possible; see DEVIATIONS."""
    same = percent / 100
    z = F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))
    off = F.aggregate(z, F.lit(0), lambda acc, w: acc + F.call_function("bit_count", reduce(Column.bitwiseOR, [F.shiftrightunsigned(w, k) for k in (1, 2, 3)], w).bitwiseAND(F.lit(_NIBBLES))))
    least, most = F.least(nx, ny), F.greatest(nx, ny)
    draws = bins * (1 - F.exp(-least.cast("double") / bins))
    p = _off(same, bins) / bins
    return (100 * least >= percent * most) & (off <= _off(same, bins) + DEVIATIONS * bins * (p * (1 - p)) ** 0.5 / F.sqrt(draws))


def confirm(edges: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Edges (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    crowds = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CROWD).cast("int").alias("crowds"))
    lot = F.pmod(F.xxhash64("b"), F.col("crowds")).cast("int").alias("lot")
    ends = edges.join(crowds, "a").select("a", lot, F.col("b"), F.col("b").alias("doc_id"))
    heads = crowds.select("a", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("lot"), F.lit(None).cast("long").alias("b"), F.col("a").alias("doc_id"))
    need = cut(heads.unionByName(ends), "need")
    rows = texts.join(_small(need), "doc_id").select("a", "lot", "b", "text")
    rows = rows.repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_others("near_dedup")
        at: tuple[int, int] | None = None
        heads: list[np.ndarray] = []
        for pdf in batches:
            out = []
            for a, lot, b, text in zip(pdf["a"], pdf["lot"], pdf["b"], pdf["text"]):
                s = shingles_of(text, shingle)
                if pd.isna(b):
                    heads, at = ([*heads, s] if at == (a, lot) else [s]), (a, lot)
                elif any(_linked(x, s, percent) for x in heads):
                    out.append((a, int(b)))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.mapInPandas(run, "a long, b long").distinct()


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.intersect1d(x, y, assume_unique=True).size
    return 100 * both >= percent * (len(x) + len(y) - both)


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    met = times > 1
    owner, at = owner[met[at]], (np.cumsum(met) - 1)[at[met[at]]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.int32)
    for lo in range(0, int(met.sum()), BLOCK):
        i, j = np.searchsorted(at, (lo, lo + BLOCK))
        m = np.zeros((len(sets), BLOCK), np.float32)
        m[owner[i:j], at[i:j] - lo] = 1
        out += (m @ m.T).astype(np.int32)
    return out


def _label(member: DataFrame, label: DataFrame | None) -> DataFrame:
    """member with comp, the component of each row by label."""
    if label is None:
        return member.withColumn("comp", F.col("doc_id"))
    cur = member.join(label.select(F.col("node").alias("doc_id"), F.col("component").alias("comp")), "doc_id", "left")
    return cur.withColumn("comp", F.coalesce("comp", "doc_id"))


def _group_pairs(pdf: pd.DataFrame, percent: int, bins: int) -> pd.DataFrame:
    """Of the members of two units those with a pair to compare, each with its partners of larger place."""
    keys = np.stack(pdf["keys"].to_numpy())
    sketch = np.stack(pdf["sketch"].to_numpy()).view(np.uint64)
    n, comp, side, doc = (pdf[c].to_numpy() for c in ("n_shingles", "comp", "side", "doc_id"))
    across = side.min() != side.max()
    same, size = percent / 100, len(pdf)
    p = _off(same, bins) / bins
    draws = bins * (1 - np.exp(-n / bins))
    codes, held = [], 0
    for band in range(keys.shape[1]):
        order = np.argsort(keys[:, band], kind="stable")
        k = keys[order, band]
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1], True])
        for lo, hi in zip(starts[:-1], starts[1:]):
            if hi - lo < 2:
                continue
            x = np.sort(order[lo:hi])
            for i in range(0, len(x), 256):
                r, c = np.triu_indices(len(x) - i, 1) if len(x) - i <= 256 else np.nonzero(np.arange(i, i + 256)[:, None] < np.arange(len(x))[None, :])
                a, b = (x[i + r], x[i + c]) if len(x) - i <= 256 else (x[i + r], x[c])
                ok = (comp[a] != comp[b]) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
                if across:
                    ok &= side[a] != side[b]
                a, b = a[ok], b[ok]
                if len(a):
                    codes.append(a.astype(np.int64) * size + b)
                    held += len(a)
                if held > 8 * PAIRS:
                    codes = [np.unique(np.concatenate(codes))]
                    held = 0
                if len(x) - i <= 256:
                    break
    code = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
    keep = np.zeros(len(code), bool)
    for i in range(0, len(code), PAIRS):
        a, b = code[i : i + PAIRS] // size, code[i : i + PAIRS] % size
        z = sketch[a] ^ sketch[b]
        z = (z | z >> np.uint64(1) | z >> np.uint64(2) | z >> np.uint64(3)) & np.uint64(_NIBBLES)
        off = np.bitwise_count(z).sum(1)
        keep[i : i + PAIRS] = off <= _off(same, bins) + DEVIATIONS * bins * (p * (1 - p)) ** 0.5 / np.sqrt(np.minimum(draws[a], draws[b]))
    a, b = code[keep] // size, code[keep] % size
    need = np.unique(np.concatenate([a, b]))
    ends = np.searchsorted(a, need, "left"), np.searchsorted(a, need, "right")
    out = pd.DataFrame({"u": pdf["u"].iloc[0], "v": pdf["v"].iloc[0], "doc_id": doc[need], "comp": comp[need]})
    out["partners"] = pd.Series([doc[b[i:j]] for i, j in zip(*ends)], dtype=object)
    return out


def _group_links(pdf: pd.DataFrame, shingle: int, percent: int) -> pd.DataFrame:
    """Links between the components of a group, as few as join what belongs together."""
    forget_others("near_dedup")
    sets = [shingles_of(t, shingle) for t in pdf["text"]]
    doc, comp = pdf["doc_id"].to_numpy(), pdf["comp"].to_numpy()
    place: dict[int, list[int]] = {}
    for i, d in enumerate(doc):
        place.setdefault(int(d), []).append(i)
    pairs = sorted({(i, j) for i, ps in enumerate(pdf["partners"]) for p in ps for j in place.get(int(p), ())})
    root = {c: c for c in comp}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    both = common(sets) if len(pairs) > 8 * len(sets) else None
    out = []
    for i, j in pairs:
        if both is None:
            x, y = find(comp[i]), find(comp[j])
            ok = x != y and _linked(sets[i], sets[j], percent)
        else:
            ok = 100 * both[i, j] >= percent * (len(sets[i]) + len(sets[j]) - both[i, j])
            if ok:
                x, y = find(comp[i]), find(comp[j])
                ok = x != y
        if ok:
            root[max(x, y)] = min(x, y)
            out.append((doc[i], doc[j]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def exact_links(member: DataFrame, active: DataFrame, docs: DataFrame, label: DataFrame | None, shingle: int, percent: int, bins: int) -> DataFrame | None:
    """Links (a, b) among all members of each bucket (key, size, doc_id), between components; None without any to try."""
    cur = _label(member.select("key", "size", "doc_id"), label)
    mixed = cur.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    cur = cut(cur.join(mixed, "key", "left_semi"), "open")
    if cur.isEmpty():
        drop(cur)
        return None
    home = cur.groupBy("doc_id", "comp").agg(F.max(F.struct("size", "key")).alias("home"))
    top = cur.join(home.select("doc_id", "home"), "doc_id").groupBy("key").agg(F.max("home").alias("top"))
    size = active.groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    home = home.select("doc_id", "comp", F.col("home.key").alias("key")).join(top, "key").join(size, "doc_id")
    home = cut(home.select("doc_id", "comp", F.col("top.key").alias("family"), "n"), "homes")

    parts = home.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    parts = parts.withColumn("big", (F.col("m") > UNIT // 2) | (F.col("w") > WEIGHT // 2))
    few = lambda c: F.coalesce(F.sum(F.when(~F.col("big"), F.col(c))), F.lit(0))
    rest = parts.groupBy("family").agg(few("m").alias("fm"), few("w").alias("fw")).withColumn("loose", (F.col("fm") <= UNIT // 2) & (F.col("fw") <= WEIGHT // 2))
    parts, rest = cut(parts, "parts"), cut(rest, "families")
    loose = max(1, -(-int(rest.where("loose").agg(F.coalesce(F.sum("fw"), F.lit(0))).first()[0]) // WEIGHT))
    lots = lambda m, w: F.ceil(F.greatest(F.col(m) / UNIT, F.col(w) / WEIGHT))
    unit = (
        F.when(F.col("big"), F.xxhash64(F.lit(1), "family", "comp", F.pmod(F.xxhash64("doc_id"), lots("m", "w"))))
        .when(F.col("loose"), F.xxhash64(F.lit(2), F.pmod(F.xxhash64("family"), F.lit(loose))))
        .otherwise(F.xxhash64(F.lit(3), "family", F.pmod(F.xxhash64("comp"), lots("fm", "fw"))))
    )
    home2 = home.join(parts, ["family", "comp"]).join(rest, "family").select("doc_id", unit.alias("unit"), F.when(F.col("big"), F.col("comp")).alias("tag"))
    m = cut(cur.join(home2, "doc_id").select("key", "doc_id", "comp", "unit", "tag"), "units")
    unit = m.select("key", F.struct("unit", "tag").alias("u")).distinct()
    # Two units of one large component have nothing to compare.
    two = unit.join(unit.withColumnRenamed("u", "v"), "key").where("u.unit <= v.unit and not coalesce(u.tag = v.tag, false)")
    two = two.select("key", F.col("u.unit").alias("u"), F.col("v.unit").alias("v"), F.explode(F.expr("array_distinct(array(u.unit, v.unit))")).alias("unit"))
    rows = two.join(m, ["key", "unit"]).select("u", "v", (F.col("unit") == F.col("u")).alias("side"), "doc_id", "comp").distinct().join(active, "doc_id")
    pairs = cut(rows.groupBy("u", "v").applyInPandas(lambda pdf: _group_pairs(pdf, percent, bins), "u long, v long, doc_id long, comp long, partners array<long>"), "pairs")
    drop(cur, home, parts, rest, m)
    texts = _texts(docs, pairs.select("doc_id").distinct())
    found = cut(pairs.join(texts, "doc_id").groupBy("u", "v").applyInPandas(lambda pdf: _group_links(pdf, shingle, percent), "a long, b long"), "found")
    drop(pairs, texts)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs."""
    bins = bands * rows
    sig = cut(signatures(docs, shingle, bands, rows), "signatures")
    solid = sig.where("set_key is not null and doc_id is not null")
    shared = solid.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    shared = cut(shared.where("copies > 1").select("set_key", "rep"), "classes")
    blocks = bloom_blocks(shared.count())
    bloom = F.broadcast(bloom_table(shared, F.col("set_key"), blocks))
    told = solid.select("*", *bloom_probe(F.col("set_key"), blocks)).join(bloom, "block", "left")
    maybe = F.coalesce(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False))
    alone = told.where(~maybe).select(*sig.columns)
    reps = told.where(maybe).select(*sig.columns).join(shared, "set_key", "left").where("rep is null or doc_id = rep").select(*sig.columns).unionByName(alone)

    member = reps.select("doc_id", F.explode("keys").alias("key"))
    # Buckets of one member are dropped before anything else is done with them.
    buckets = member.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("size"))
    buckets = cut(buckets.where("lo < hi"), "buckets")
    large = buckets.where("size > 2")
    crowd = _maybe_among(member, large.select("key"), "key").join(large.select("key", "lo", "size"), "key")
    crowd = cut(crowd.distinct(), "members")
    edges = buckets.where("size = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    edges = edges.unionByName(crowd.where("doc_id <> lo").select(F.col("lo").alias("a"), F.col("doc_id").alias("b")))
    edges = cut(edges.distinct(), "edges")
    active = _maybe_among(reps, edges.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id")
    active = cut(active.select("doc_id", "n_shingles", "keys", "sketch"), "active")
    drop(buckets)

    end = lambda e: active.select(F.col("doc_id").alias(e), F.col("n_shingles").alias(f"n{e}"), F.col("sketch").alias(f"s{e}"))
    close = edges.join(end("a"), "a").join(end("b"), "b").where(near_enough("sa", "sb", "na", "nb", percent, bins))
    close = cut(close.select("a", "b").distinct(), "close")
    texts = _texts(docs, close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    found = cut(confirm(close, texts, shingle, percent), "found")
    drop(edges, close, texts)
    label = None if found.isEmpty() else components(found)
    more = exact_links(crowd, active, docs, label, shingle, percent, bins)
    if more is not None and not more.isEmpty():
        known = found if label is None else label.select(F.col("node").alias("a"), F.col("component").alias("b"))
        label = components(known.unionByName(more))
    drop(crowd, active, found, more)

    out = sig.select("doc_id", "n_shingles", "set_key").join(shared, "set_key", "left")
    out = out.withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
    if label is not None:
        out = out.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    else:
        out = out.withColumn("component", F.col("rep"))
    out = out.withColumn("component_id", F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays, whole."""
    gone = near_duplicates(docs, shingle, percent).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("_any"))
    gone = gone.where("not _any").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti").select(*docs.columns)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
