"""Token counts of flat, unindexed token files by a separator scan.

A flat file is nothing but token ids of fixed width, big-endian, with an end-of-document
id after each document.  Spark reads byte ranges of the files, so a file may be of any
size; each task glues what it reads to blocks, and each block finds its separators with
one vectorised comparison.  A block does not know whether it begins inside a token, so it
looks at every alignment; a prefix scan over the blocks' sizes tells which one holds, and
the same scan stitches documents, and tokens, that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.bpe import codec, rank_file
from tickloom.llm.common import lean, materialise, small_batches

#: Bytes of a block, and the byte at which Spark cuts ranges; any byte value serves, a rare one gives fewer rows.
BLOCK, CUT = 1 << 20, b"\x7f"
#: Blocks of one range at most, as a power of two.
RANGE_BLOCKS = 20
#: Outer blocks of files, two a file, that may be broadcast; some 150 bytes each.
EDGES = 100_000


def write_flat(docs: DataFrame, path: str, ranks_path: str, pattern: str, end_id: int, width: int = 2, text: str = "text") -> None:
    """Encode every whole text and write flat token files, one for each input partition.

    Spark's text writer puts a separator after each row; that byte is the last one of the
    end-of-document id, so the files hold token bytes only.  Null texts are empty documents,
    repeated rows are documents of their own, an empty table gives no bytes; other columns
    are not read.
    """
    small_batches(docs.sparkSession)
    end = int(end_id).to_bytes(width, "big")
    if end[-1] >= 0x80:
        raise ValueError("the last byte of the end-of-document id must be below 128")
    lines = docs.sparkSession.sparkContext.broadcast(rank_file(ranks_path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(lines.value, pattern)
        if max(bpe.bytes) >= min(1 << 8 * width, end_id if end_id in bpe.bytes else 1 << 8 * width):
            raise ValueError("a token id does not fit, or is the end-of-document id")
        for batch in batches:
            rows = [b"".join(np.asarray(part, f">u{width}").tobytes() for part in bpe.encode_chunks(t or "")) + end[:-1] for t in batch["text"]]
            yield pd.DataFrame({"value": pd.Series(rows, dtype=object)})
        bpe.forget()

    raw = docs.select(docs[text].alias("text")).mapInPandas(lean(run), "value binary")
    raw.select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", chr(end[-1])).text(path)


def read_blocks(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """(file, block, data) of all flat files under ``path``; ``block`` grows with the place in the file.

    Spark's text reader splits files of any size into ranges, at a byte instead of a line
    end; its rows are glued together again to blocks of about ``block`` bytes.
    """
    m = F.col("_metadata")
    rows = spark.read.option("lineSep", CUT.decode()).text(path)
    rows = rows.select(m["file_path"].alias("file"), m["file_size"].alias("size"), m["file_block_start"].alias("at"), m["file_block_length"].alias("span"), F.col("value").cast("binary").alias("data"))

    def glue(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, nth, held, size = None, 0, [], 0

        def made() -> pd.DataFrame:
            return pd.DataFrame({"file": [now[0]], "block": [(now[1] << RANGE_BLOCKS) + nth], "data": [b"".join(held)]})

        for batch in batches:
            for file, at, data in zip(batch["file"], batch["at"], batch["data"], strict=True):
                if (file, at) != now or size >= block:
                    if held:
                        yield made()
                    nth = nth + 1 if (file, at) == now else 0
                    now, held, size = (file, at), [], 0
                held += (data, CUT)
                size += len(data) + 1
        if held:
            yield made()

    glued = rows.select("file", "at", "data").mapInPandas(lean(glue), "file string, block long, data binary")
    # the reader says nothing of a cut behind the last row, nor of a byte order mark that it took for one
    sizes = rows.groupBy("file").agg(F.first("size").alias("size"), F.sum(F.octet_length("data") + 1).alias("read"))
    first = Window.partitionBy("file").orderBy("block")
    ends = glued.select("file", "block").withColumns({"lead": F.row_number().over(first), "last": F.lead("block").over(first).isNull()}).where(F.col("last") | (F.col("lead") == 1))
    known = materialise(ends.join(sizes, "file").select("file", "block", "last", (F.col("size") - F.col("read")).alias("more"), (F.col("lead") == 1).alias("lead")))
    both = glued.join(F.broadcast(known) if known.count() <= EDGES else known, ["file", "block"], "left")  # else the blocks would be shuffled
    missing = F.col("more") >= 2  # size - read is 0, or -1 without a cut at the end; a mark adds its 3 bytes
    data = F.when(F.col("lead") & missing, F.concat(F.lit(b"\xef\xbb\xbf"), F.col("data"))).otherwise(F.col("data"))
    cut = F.col("last") & F.col("more").isin(-1, 2)
    return both.select("file", "block", data.alias("data"), cut.alias("cut")).select("file", "block", F.when(F.col("cut"), F.expr("substring(data, 1, length(data) - 1)")).otherwise(F.col("data")).alias("data"))


def count_tokens(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """(file, doc, n_tokens, ended) for every document in the blocks of flat files.

    ``blocks``: file, block (ordered in the file) and data; a block may end inside a token.
    ``doc`` counts from 0 in each file.  Empty documents count; what follows the last
    separator of a file is a document with ``ended`` false if it has a token.  A trailing
    part of a token is left out.  Null and empty data are blocks of no bytes; no blocks give
    no rows; other columns are not read.
    """
    kind = {1: np.dtype("u1"), 2: np.dtype(">u2"), 4: np.dtype(">u4")}[width]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data in batch["data"]:
                data = data or b""
                found = []
                for skip in range(width):  # bytes of the block that belong to a token begun before it
                    ids = np.frombuffer(data, kind, count=max(0, len(data) - skip) // width, offset=min(skip, len(data)))
                    found.append((np.flatnonzero(ids == end_id) * width + skip).tolist())
                out.append((len(data), data[: width - 1].hex(), data[len(data) - min(width - 1, len(data)) :].hex(), found))
            yield pd.DataFrame({"file": batch["file"], "block": batch["block"]}).join(pd.DataFrame(out, columns=["n", "head", "tail", "found"], index=batch.index))

    seen = blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInPandas(lean(scan), "file string, block long, n long, head string, tail string, found array<array<long>>").where("n > 0")
    order = Window.partitionBy("file").orderBy("block")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    scan_ = seen.withColumn("begin", F.coalesce(F.sum("n").over(past), F.lit(0)))
    scan_ = scan_.withColumn("tails", F.array_join(F.collect_list("tail").over(order.rowsBetween(-width, -1)), ""))
    # the token that the block begins inside: its first bytes are the last ones read before
    inside = F.pmod(F.col("begin"), F.lit(width)).cast("int")
    skip = F.pmod(F.lit(width) - inside, F.lit(width)).cast("int")
    across = F.concat(F.expr("right(tails, 2 * cast(pmod(begin, %d) as int))" % width), F.substring("head", F.lit(1), 2 * skip))
    stitched = (inside > 0) & (across == F.lit(int(end_id).to_bytes(width, "big").hex()))
    token = F.floor(F.col("begin") / width).cast("long")
    at = F.transform(F.element_at("found", skip + 1), lambda x: F.floor((F.col("begin") + x) / F.lit(width)).cast("long"))
    scan_ = scan_.withColumn("ends", F.concat(F.when(stitched, F.array(token)).otherwise(F.array().cast("array<bigint>")), at))
    scan_ = scan_.withColumn("doc", F.coalesce(F.sum(F.size("ends")).over(past), F.lit(0)))
    scan_ = scan_.withColumn("open", F.coalesce(F.max(F.array_max("ends")).over(past), F.lit(-1)))
    scan_ = scan_.withColumn("last", F.lead("block").over(order).isNull())
    each = scan_.select("file", "doc", "open", "ends", F.posexplode("ends")).select("file", (F.col("doc") + F.col("pos")).alias("doc"), (F.col("col") - F.when(F.col("pos") > 0, F.get("ends", F.col("pos") - 1)).otherwise(F.col("open")) - 1).alias("n_tokens"), F.lit(True).alias("ended"))
    left = F.floor((F.col("begin") + F.col("n")) / F.lit(width)).cast("long") - F.greatest(F.coalesce(F.array_max("ends"), F.lit(-1)), F.col("open")) - 1
    open_ = scan_.where(F.col("last")).select("file", (F.col("doc") + F.size("ends")).alias("doc"), left.alias("n_tokens"), F.lit(False).alias("ended")).where("n_tokens > 0")
    return each.unionByName(open_)
