"""Best-fit packing of token pieces with Martello-Toth dominance reduction.

Pieces have at most `capacity` distinct lengths, so the packing problem is the histogram of lengths, whatever the size
of the corpus. Three steps:

1. Documents are tokenised on the executors and cut into pieces; the piece table goes to the shared folder.
2. The driver gets one count per length (at most `capacity` numbers). The Martello-Toth reduction fixes sets that
   dominate every alternative: a piece that fits with nothing, a pair that fills the sequence, a pair or triple that no
   other feasible set of its first piece beats. Each fixed set is taken as often as the counts allow. What remains is
   packed best-fit in descending length, by classes of equally filled sequences. The plan is a list of runs (length,
   first rank, number of pieces, ...); each step of it uses up a length or a class, so its size is bounded by the
   capacity and not by the corpus.
3. Every piece gets its rank among those of its length (ranks within salted slices plus the slices' offsets, so a
   length that a third of all documents share is dealt over many tasks) and looks up its place in the plan. A length has
   slices by its share of the pieces, so there are at most `capacity` slices more than the salt asks for.

Cases: a null or empty text is one piece with the end id alone; other columns are ignored; repeated rows are packed
each. A text that is longer than the capacity is cut, and only such a text.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, forget_others, partitions, remember, table

CAPACITY = 2048
END_ID = 0
#: Words whose ids a worker remembers; then it begins anew.
CACHE_WORDS = 600_000
LONGEST_CACHED = 48
#: Rows of one length that a task ranks at most, about; the salt follows the number of rows.
ROWS_PER_SLICE = 200_000

_WORDS: dict[str, dict[str, bytes]] = remember("packing")
_TOKENIZERS: dict[str, object] = remember("packing")
#: Ids of the parts of words; None for a tokenizer that splits words in another way.
_PIECES: dict[str, dict[str, bytes] | None] = remember("packing")


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


#: Words of these characters are in composed form, and each becomes lower case by itself.
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
#: How the tokenizer splits such words, in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
#: The parts of a tokenizer that _SIMPLE and _PARTS stand for.
_STEPS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    "ByteLevel",
)


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(0x100 + k) for k, b in enumerate(x for x in range(0x100) if x not in own)}


_BYTE_CHARS = _byte_chars()


def _steps(path: str) -> tuple:
    conf = json.loads(_tokenizer(path).to_str())
    split, *rest = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
    return conf.get("normalizer"), split, ",".join(x["type"] for x in rest)


def _encode_words(path: str, words: list[str]) -> dict[str, bytes]:
    """Ids of each word as little-endian bytes. Words of simple characters go part by part to the tokenizer's model, each
    part once while remembered; all others, and those that may hold a special token, go through the whole tokenizer."""
    tok, out = _tokenizer(path), {}
    if path not in _PIECES:
        _PIECES[path] = {} if _steps(path) == _STEPS else None
    known = _PIECES[path]
    if known is not None:
        if len(known) > CACHE_WORDS:
            known.clear()
        tokenize = tok.model.tokenize

        def ids_of(part: str) -> bytes:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_CHARS)
            got = b"".join([t.id.to_bytes(4, "little") for t in tokenize(shown)])
            if len(part) <= LONGEST_CACHED:
                known[part] = got
            return got

        for w in words:
            if _SIMPLE(w) and "<|" not in w:
                low = w if w.islower() else w.lower()  # one string for both stores
                if low.isalpha():
                    out[w] = known.get(low) or ids_of(low)
                else:
                    out[w] = b"".join([known.get(p) or ids_of(p) for p in _PARTS(low)])
    for w in words:
        if w not in out:
            out[w] = np.array(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
    return out


_ASCII_WS = re.compile(r"[\x20\x09-\x0D]+")
#: str.split() also takes these for white space; the tokenizer does not.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")


def token_bytes(path: str, texts: list[str]) -> Iterator[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit numbers. The tokenizer drops white space and no token or
    normalisation reaches across it, so words are encoded by themselves, each once a batch, and remembered."""
    cache = _WORDS.setdefault(path, {})
    for i in range(0, len(texts), 256):
        part = [t.split() if t.isascii() and not _SEPARATORS.search(t) else _ASCII_WS.sub(" ", t).strip(" ").split(" ") if t else [] for t in texts[i : i + 256]]
        seen: set[str] = set()
        for words in part:
            seen.update(words)
        if len(cache) > CACHE_WORDS:
            cache.clear()
        seen.difference_update(cache)
        seen.discard("")
        cache.update(_encode_words(path, list(seen)))
        cache[""] = b""
        for words in part:
            yield b"".join(map(cache.__getitem__, words))
        for w in seen:
            if len(w) > LONGEST_CACHED:
                del cache[w]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_others("packing")
        for pdf in batches:
            rows = []
            for doc, raw in zip(pdf["doc_id"], token_bytes(tokenizer_path, ["" if t is None else t for t in pdf["text"]])):
                raw += tail
                n = len(raw) // 4
                for k, a in enumerate(range(0, n, capacity)):
                    part = raw[4 * a : 4 * (a + capacity)]
                    rows.append((doc, k, a, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64") if rows else out["doc_id"]
            yield out

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Plan:
    """Runs of the packing: for a length, ranks [rank, rank + per*times) lie `per` to a sequence, from `base` on, at
    `offset` and then one behind the other."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = defaultdict(int)
        self.sequences = 0

    def emit(self, lengths: list[tuple[int, int]], times: int) -> None:
        offset = 0
        for length, per in lengths:
            self.runs.append((length, self.used[length], per, self.sequences, offset))
            self.used[length] += per * times
            offset += length * per
        self.sequences += times


def reduce_dominated(counts: dict[int, int], capacity: int, plan: Plan) -> None:
    """Martello and Toth's reduction on a histogram; takes fixed sets out of counts and puts them into the plan.

    For a piece j, k is how many of the smallest others fit beside it. k = 0: {j}. k = 1, or the largest fitting piece
    fills up: {j, that}. k = 2: the pair when the largest fitting piece weighs no less than the best two, or the triple
    of the best two when the larger of them is the largest fitting piece and no two smaller ones could be better."""
    sizes = sorted(x for x in counts if counts[x])

    def take(group: list[int]) -> None:
        need: dict[int, int] = defaultdict(int)
        for x in group:
            need[x] += 1
        times = min(counts[x] // n for x, n in need.items())
        plan.emit(sorted(need.items(), reverse=True), times)
        for x, n in need.items():
            counts[x] -= n * times
            if not counts[x]:
                sizes.pop(bisect_left(sizes, x))

    def smallest(n: int, without: int) -> list[int]:
        out: list[int] = []
        for x in sizes:
            out += [x] * min(n - len(out), counts[x] - (x == without))
            if len(out) == n:
                break
        return out

    def largest_within(room: int, *without: int) -> int:
        """The largest piece that fits into room beside those named; 0 if there is none."""
        i = bisect_left(sizes, room + 1) - 1
        while i >= 0 and counts[sizes[i]] <= without.count(sizes[i]):
            i -= 1
        return sizes[i] if i >= 0 else 0

    for j in sorted(sizes, reverse=True):
        while counts[j]:
            room = capacity - j
            low = smallest(3, j)
            k = sum(1 for n in range(1, len(low) + 1) if sum(low[:n]) <= room)
            if k == 0:
                take([j])
                continue
            best = largest_within(room, j)
            if k == 1 or best == room:
                take([j, best])
                continue
            if k > 2:
                break
            top, pair = 0, (0, 0)
            for a in reversed(sizes[: bisect_left(sizes, room + 1)]):
                if 2 * a < top:
                    break
                if counts[a] <= (a == j):
                    continue
                b = largest_within(min(room - a, a), j, a)
                if b and a + b > top:
                    top, pair = a + b, (a, b)
            a, b = pair
            if best >= top:
                take([j, best])
            elif a == best and not largest_within(b - 1, j, a):
                take([j, a, b])  # nothing smaller than b is there to replace it
            else:
                break


def best_fit(counts: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best-fit decreasing on a histogram. A class is a number of sequences that are filled alike; a length goes to
    the fullest class that has room, as many pieces to each of its sequences as fit."""
    classes: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, times: int, content: tuple) -> None:
        if times:
            if room not in classes or not classes[room]:
                insort(rooms, room)
            classes[room].append((times, content))

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                room, times, content = capacity, -(-left // per), ()
            else:
                room = rooms[at]
                times, content = classes[room].pop()
                if not classes[room]:
                    rooms.pop(at)
            per = room // length
            full = min(times, left // per)
            put(room - per * length, full, (content, length, per))
            left -= full * per
            rest = times - full
            if rest and left:  # fewer than `per` are left: they share one sequence
                put(room - left * length, 1, (content, length, left))
                left, rest = 0, rest - 1
            put(room, rest if content else 0, content)
        counts[length] = 0
    for room in rooms:
        for times, content in classes[room]:
            items: list[tuple[int, int]] = []
            while content:
                content, length, per = content
                items.append((length, per))
            plan.emit(items[::-1], times)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan, left = Plan(), {int(k): int(v) for k, v in counts.items() if v}
    reduce_dominated(left, capacity, plan)
    best_fit(left, capacity, plan)
    return plan


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    p = cut(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    total = p.count()
    salts = max(partitions(spark), -(-total // ROWS_PER_SLICE))
    sizes = cut(p.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "lengths")  # at most `capacity` rows
    counts = {r[0]: r[1] for r in sizes.collect()}
    share = sizes.select("length", F.ceil(F.col("n") * (salts / max(1, total))).alias("lots"))
    p = p.join(F.broadcast(share), "length")
    p = p.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.col("lots")).cast("int")).drop("lots")
    p = cut(p, "sliced")
    slices = p.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    plan = plan_packing(counts, capacity)
    runs = np.array(sorted(plan.runs) or [(0, 0, 1, 0, 0)], dtype=np.int64)
    keys = runs[:, 0] * (1 << 48) + runs[:, 1]

    # Ranks: (length, slice) has at most ROWS_PER_SLICE rows or so, and there are few slices: their offsets are a small table.
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece")
    ranked = p.withColumn("r", F.row_number().over(within)).join(offsets, ["length", "slice"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") - 1 + F.col("before")).cast("long").alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            at = runs[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1]
            nth = rank - at[:, 1]
            pdf["sequence_id"] = at[:, 3] + nth // at[:, 2]
            pdf["offset"] = at[:, 4] + nth % at[:, 2] * length
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            yield pdf.drop(columns="rank")

    return ranked.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_tokenizer_path())
