"""Shared pieces of the corpus operators: the shared scratch folder and table reading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of the white space that all contracts name: space, tab, LF, VT, FF, CR.
WS_RUN = r"[\x20\x09-\x0D]+"


#: Scratch tables that have not been deleted, oldest first.
_OPEN: list[DataFrame] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Where it is unset, a folder in the warehouse, which
    executors share too; only a local session, which is one machine, gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.startswith("local"):
            root = "file://" + tempfile.mkdtemp(prefix="trackloom-")
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_trackloom_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def cut(df: DataFrame, label: str = "t") -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and a lost executor costs no
    recomputation. The table keeps its columns apart, so later scans are pruned."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    _OPEN.append(out)
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete scratch tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            sc = t.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
            _OPEN[:] = [x for x in _OPEN if x is not t]


def mark() -> int:
    """How many scratch tables are open; see sweep."""
    return len(_OPEN)


def sweep(since: int, *keep: DataFrame) -> None:
    """Delete the scratch tables written since the mark, but for those to keep."""
    drop(*[t for t in _OPEN[since:] if not any(t is k for k in keep)])


#: What a Python worker remembers from task to task, by the operator that fills it.
_REMEMBERED: dict[str, list[dict]] = {}


def remember(operator: str) -> dict:
    """A store that outlives tasks; see forget_others."""
    store: dict = {}
    _REMEMBERED.setdefault(operator, []).append(store)
    return store


def forget_others(operator: str) -> None:
    """Empties the stores of all other operators, and gives Arrow's unused memory back. Workers outlive the stages of a
    pipeline; called as a task begins, this keeps a worker's memory that of one operator instead of the sum of all."""
    import pyarrow as pa

    found = [store for name, stores in _REMEMBERED.items() if name != operator for store in stores if store]
    for store in found:
        store.clear()
    if found:
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Blocks of a Bloom filter at most, so its table may be broadcast whatever the data; beyond it only the share of false
#: positives rises.
MOST_BLOCKS = 1 << 20


def bloom_probe(key: Column, blocks: int) -> tuple[Column, Column]:
    """`block` and the four `bits` of a key in a blocked Bloom filter of 64-bit blocks."""
    h = F.xxhash64(key, F.lit(7))
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, n).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12)).bitwiseOR(bit(18)).alias("bits")


def bloom_blocks(n_keys: int) -> int:
    return min(MOST_BLOCKS, max(64, 1 << (n_keys // 4).bit_length()))


def bloom_table(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """(block, word) of all keys: at most MOST_BLOCKS rows."""
    return keys.select(*bloom_probe(key, blocks)).groupBy("block").agg(F.bit_or("bits").alias("word"))
