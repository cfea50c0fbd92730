"""Token-id files with a minimal perfect hash index.

Documents are range-partitioned by id, encoded, and written as block rows of
Spark-written Parquet files, so any store that Spark reaches will do and a
lost task is simply written again.  A block holds

* ``ids``: the raw token ids of its documents, one after another, little
  endian, ``width`` bytes each (2 if the vocabulary allows, else 4);
* ``doc_ids``, ``starts``: the documents in order and where each begins.

``part`` and ``seq`` order the blocks (``block`` is both in one number), each in
a row group of its own or nearly so.  Global offsets are prefix sums over the
blocks' totals, so no task sees more than the totals.

Beside the blocks (``ids``) stands the index over all keys (``index``).  A key's
hash names one of ``shards`` index rows of about ``SHARD_KEYS`` keys; in it
another hash names a seed bucket, hash and seed name one of as many slots as
the row has keys, and the slot holds the key's 16-bit fingerprint, its block
and its place there.  So a lookup reads one index row, in a folder found from
the key, and one block, in a file found from the entry, however many there
are; the rows are built in Spark, one group per shard.

Defined cases: a null or empty text is the end id alone; rows that repeat a
``doc_id`` stand next to each other ordered by text, share one index entry
that finds the first, and each has its row; a null ``doc_id`` comes first and is not
indexed; an empty table gives empty files and an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from squall.folders import names
from squall.llm.common import bounded_batches, cut_lineage, drop_path
from squall.session import scratch_path

END_ID = 1
BLOCK_IDS = 1 << 20
BLOCK_DOCS = 4096
_KEPT = 400_000
SHARD_KEYS = 4096
GROUP_SHARDS = 64
_BLOCK = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("continues", pa.bool_()),
                    ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32())]
                   + [(n, pa.binary()) for n in ("ids", "doc_ids", "nulls", "starts")])
_BLOCK_SQL = ("block long, part int, seq int, continues boolean, n_docs int, n_ids long, width int, "
              "ids binary, doc_ids binary, nulls binary, starts binary")
_ENTRY = "doc_id long, block long, place int"
_INDEX = "shard long, shards long, seeds binary, prints binary, blocks binary, places binary"
# a row group is closed after every row that fills it
_ROW_GROUPS = {"parquet.block.size": str(1 << 20), "parquet.block.size.row.check.min": "1",
               "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}

# Fixed value: the split pattern of the vocabulary whose words are memoised
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same pattern over lower-case words of printable ASCII and Latin-1 letters,
# which normalisation leaves alone but for case
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
# byte-level form: bytes that are not printable in Latin-1 move up, in order
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Memo(dict):
    """Results of the last ``_KEPT`` to twice ``_KEPT`` arguments used: a full
    memo becomes the old one, from which what is used again moves on."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= _KEPT:
            self.old = dict(self)
            self.clear()
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        self[key] = out
        return out


class Encoder:
    """Text to id bytes with the tokenizers library.

    A tokenizer that cuts at blanks and drops them gives a text the ids of its
    words in a row, so the ids of a word are kept and used again; any other
    tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = self._cuts_at_blanks(spec)
        self.words = _Memo(self._word)
        self.pieces = _Memo(self._piece)

    @staticmethod
    def _cuts_at_blanks(spec: dict) -> bool:
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        norm = (spec.get("normalizer") or {}).get("normalizers") or []
        return (pre[0].get("type") == "Split" and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True
                and pre[0]["pattern"].get("Regex") == _WORD_PATTERN
                and [p.get("type") for p in pre[1:]] == ["ByteLevel"] and not pre[1].get("add_prefix_space")
                and [n.get("type") for n in norm] == ["NFC", "Replace", "Lowercase"]
                and not spec.get("post_processor")
                and not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip")
                            for t in spec.get("added_tokens", [])))

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return self._bytes([t.id for t in self.tok.model.tokenize(piece)])

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self.pieces[p] for p in _PLAIN_PIECES.findall(text.lower())])
        return self._bytes(self.tok.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        if not self.by_word:
            return self._bytes(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, text.split()))


def encoder(path: str) -> Encoder:
    """The worker process's encoder of a vocabulary: opened once, and its memo
    (bounded) serves all tasks that the worker runs."""
    import tokenizers  # a module of the worker's own, unlike this one, which travels with each task
    held = tokenizers.__dict__.setdefault("__squall_encoders__", {})
    if path not in held:
        held.clear()
        held[path] = Encoder(path)
    return held[path]


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _hash(x: np.ndarray) -> np.ndarray:
    h = x.astype(np.uint64) + _A
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (_hash(h ^ (seed.astype(np.uint64) * _B)) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash-and-displace over distinct integer keys: (seeds, fingerprints,
    places), the latter two with exactly one slot per key."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint16), np.zeros(0, np.uint32)
    h = _hash(keys)
    m = -(-n // 4)
    bucket = (h >> np.uint64(32)) % np.uint64(m)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(m + 1, dtype=np.uint64))
    seeds, free, places = np.zeros(m, np.uint32), np.ones(n, bool), np.zeros(n, np.uint32)
    for b in sorted(range(m), key=lambda b: edges[b] - edges[b + 1]):
        own = order[edges[b]:edges[b + 1]]
        if not len(own):
            break
        step, seed = 256, 0
        while True:
            tried = np.arange(seed, seed + step)
            at = _slot(h[own][None, :], tried[:, None], n)
            ok = free[at].all(axis=1)
            if len(own) > 1:
                srt = np.sort(at, axis=1)
                ok &= (srt[:, 1:] != srt[:, :-1]).all(axis=1)
            if ok.any():
                i = int(np.argmax(ok))
                seeds[b] = tried[i]
                free[at[i]] = False
                places[at[i]] = own
                break
            seed += step
    prints = (h[places] & np.uint64(0xFFFF)).astype(np.uint16)
    return seeds, prints, places


def look_up(keys: np.ndarray, seeds: np.ndarray, prints: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places of the keys, -1 where the fingerprint says they are not there."""
    if not len(places):
        return np.full(len(keys), -1, np.int64)
    h = _hash(keys)
    seed = seeds[((h >> np.uint64(32)) % np.uint64(len(seeds))).astype(np.int64)]
    at = _slot(h, seed, len(places))
    return np.where(prints[at] == (h & np.uint64(0xFFFF)).astype(np.uint16), places[at].astype(np.int64), -1)


def _writer(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        ids: list[bytes] = []
        docs: list[int | None] = []
        held = 0
        before: int | None = None  # the last key of the block before

        def block() -> pa.RecordBatch:
            null = np.array([d is None for d in docs])
            keys = np.array([d or 0 for d in docs], np.int64)
            starts = np.cumsum([0, *(len(x) // enc.dtype.itemsize for x in ids)]).astype("<u8")
            row = [part << 32 | seq, part, seq, docs[0] is not None and docs[0] == before,
                   len(docs), int(starts[-1]), enc.dtype.itemsize, b"".join(ids), keys.astype("<i8").tobytes(),
                   null.tobytes(), starts.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(enc.encode(t.as_py() or b"") + end)
                docs.append(d)
                held += len(ids[-1]) // enc.dtype.itemsize
                if held >= BLOCK_IDS or len(docs) >= BLOCK_DOCS:
                    yield block()
                    before, ids, docs, held, seq = docs[-1], [], [], 0, seq + 1
        if docs:
            yield block()
    return run


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str | None = None, doc_id: str = "doc_id",
                      text: str = "text", end_id: int = END_ID, shard_keys: int = SHARD_KEYS) -> None:
    """Write all documents' ids, in ascending id order, and their index
    under ``path``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("t"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "t")
    (ordered.mapInArrow(_writer(tokenizer or vocabulary_path(), end_id), _BLOCK_SQL)
     .write.options(**_ROW_GROUPS).parquet(f"{path}/ids"))
    _write_index(spark, path, shard_keys)


class Block:
    """One block row, opened."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.starts = np.frombuffer(row["starts"], "<u8").astype(np.int64)

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.starts[place]:self.starts[place + 1]]


def _firsts(doc_ids: np.ndarray, nulls: np.ndarray, continues: bool) -> np.ndarray:
    """Whether a place is the first of its key in all files: equal keys stand
    together, and ``continues`` says that the block before ends with the
    block's first key."""
    new = np.ones(len(doc_ids), bool)
    new[:1] = not continues
    new[1:] = (doc_ids[1:] != doc_ids[:-1]) | nulls[:-1]
    return new & ~nulls


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to entries: each key and its first place."""
    for batch in batches:
        for block, ids, nulls, continues in zip(
                *(batch.column(n).to_pylist() for n in ("block", "doc_ids", "nulls", "continues")), strict=True):
            ids = np.frombuffer(ids, "<i8")
            at = np.flatnonzero(_firsts(ids, np.frombuffer(nulls, bool), continues))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at], pa.int64()), pa.array(np.full(len(at), block), pa.int64()),
                 pa.array(at, pa.int32())], ["doc_id", "block", "place"])


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards).cast("long"))


def _group(shard: Column) -> Column:
    return F.floor(shard / GROUP_SHARDS).cast("long")


def _build_shard(entries: pd.DataFrame) -> pd.DataFrame:
    """One index row over the distinct keys of a shard."""
    seeds, prints, at = build_index(entries["doc_id"].to_numpy(np.int64))
    return pd.DataFrame({
        "group": entries["group"].iloc[:1].to_numpy(), "shard": entries["shard"].iloc[:1].to_numpy(), "shards": entries["shards"].iloc[:1].to_numpy(),
        "seeds": [seeds.astype("<u4").tobytes()], "prints": [prints.astype("<u2").tobytes()],
        "blocks": [entries["block"].to_numpy("<i8")[at].tobytes()],
        "places": [entries["place"].to_numpy("<i4")[at].tobytes()]})


def _write_index(spark: SparkSession, path: str, shard_keys: int) -> None:
    blocks = spark.read.schema(_BLOCK_SQL).parquet(f"{path}/ids")
    n = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]  # one number
    shards = max(1, -(-n // shard_keys))
    shard = _shard(F.col("doc_id"), shards)
    entries = (blocks.select("block", "doc_ids", "nulls", "continues").mapInArrow(_keys, _ENTRY)
               .withColumns({"shard": shard, "shards": F.lit(shards).cast("long"), "group": _group(shard)}))
    # dealt by the folder, which the shards of a folder share: the rows are written where they are built
    rows = entries.repartition("group").groupBy("group", "shard").applyInPandas(_build_shard, f"group long, {_INDEX}")
    rows.write.options(**_ROW_GROUPS).partitionBy("group").parquet(f"{path}/index")


def _entries(keys: np.ndarray, index: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(block, place) of keys of one shard, -1 where its slot holds another
    fingerprint."""
    none = np.full(len(keys), -1, np.int64)
    if not len(index) or not len(keys):
        return none, none
    row = index.iloc[0]
    seeds, prints = np.frombuffer(row["seeds"], "<u4"), np.frombuffer(row["prints"], "<u2")
    slot = look_up(keys, seeds, prints, np.arange(len(prints)))
    return (np.where(slot >= 0, np.frombuffer(row["blocks"], "<i8")[slot], -1),
            np.where(slot >= 0, np.frombuffer(row["places"], "<i4")[slot], -1))


def _look_up_shard(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    block, place = _entries(keys["doc_id"].to_numpy(np.int64), index)
    return pd.DataFrame({"doc_id": keys["doc_id"], "block": block, "place": place})[block >= 0]


def _look_up(keys: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    k = keys.select("doc_id", _shard(F.col("doc_id"), shards).alias("shard"))
    return k.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up_shard, _ENTRY)


def _shards(spark: SparkSession, path: str) -> int:
    """Number of index rows, noted in each of them; 0 without any key."""
    groups = [g for g in names(spark, f"{path}/index") if g.startswith("group=")]
    if not groups:
        return 0
    return spark.read.schema(_INDEX).parquet(f"{path}/index/{groups[0]}").select("shards").first()[0]


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, block, place) of the distinct, non-null ``doc_id`` of ``keys``
    by the index alone.  A key that was never written is mostly left out; one
    in 65,536 gets another's entry, which the block then shows."""
    shards = _shards(spark, path)
    if not shards:
        return spark.createDataFrame([], _ENTRY)
    return _look_up(keys, spark.read.schema(_INDEX).parquet(f"{path}/index"), shards)


_DOC_SQL = "doc_id long, block long, place int, first boolean, at long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            b = Block(row)
            n = len(b.nulls)
            crc = [zlib.crc32(b.document(p).astype("<u4").tobytes()) for p in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.doc_ids, pa.int64(), mask=b.nulls), pa.array(np.full(n, row["block"]), pa.int64()),
                 pa.array(np.arange(n), pa.int32()), pa.array(_firsts(b.doc_ids, b.nulls, row["continues"])),
                 pa.array(b.starts[:-1], pa.int64()), pa.array(np.diff(b.starts), pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "block", "place", "first", "at", "n_tokens", "ids_crc32"])


_OUT_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _confirm(docs: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Documents of one shard, each key looked up."""
    first = docs["first"].to_numpy(bool)
    keyed = docs[first]
    block, place = _entries(keyed["doc_id"].to_numpy(np.int64), index)
    if (block != keyed["block"].to_numpy()).any() or (place != keyed["place"].to_numpy()).any():
        raise ValueError("the index does not lead to a key's document")
    return docs[["doc_id", "start", "n_tokens", "ids_crc32"]].astype({"doc_id": "Int64"})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` over 32-bit ids.  Every key is looked up:
    the job fails unless the index leads to the key's first document."""
    blocks = spark.read.schema(_BLOCK_SQL).parquet(f"{path}/ids")
    per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per partition
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    base = (blocks.select("part", "block", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq"))
                                            - F.col("n_ids")).alias("in_part"))
            .join(before, "part").select("block", (F.col("base") + F.col("in_part")).alias("base")))
    docs = blocks.mapInArrow(_read, _DOC_SQL).join(base, "block").withColumn("start", F.col("base") + F.col("at"))
    shards = _shards(spark, path)
    if not shards:  # no key at all
        return docs.select("doc_id", "start", "n_tokens", "ids_crc32")
    # rows without a key of their own (no id, or the id of the row before) are
    # spread over groups of about a shard's size that have no index row
    other = -1 - F.pmod(F.xxhash64("block", "place"), F.lit(shards).cast("long"))
    docs = docs.withColumn("shard", F.when(F.col("first"), _shard(F.col("doc_id"), shards)).otherwise(other))
    index = spark.read.schema(_INDEX).parquet(f"{path}/index")
    return docs.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_confirm, _OUT_SQL)


def blocks_of(spark: SparkSession, path: str, blocks: list[int]) -> DataFrame:
    """The named blocks; only the files and row groups that hold them are read."""
    parts = sorted({b >> 32 for b in blocks})
    rows = spark.read.schema(_BLOCK_SQL).option("pathGlobFilter", "part-{%s}-*" % ",".join(f"{p:05d}" for p in parts))
    return rows.parquet(f"{path}/ids").filter(F.col("block").isin(sorted(set(blocks))))


def fetch(spark: SparkSession, path: str, ids: list[int], max_keys: int = 10_000) -> DataFrame:
    """(doc_id, ids) of a bounded list of keys: reads the index rows of the
    keys and the blocks that these name."""
    if len(ids) > max_keys:
        raise ValueError(f"{len(ids)} keys; at most {max_keys} in one call")
    shards = _shards(spark, path)
    keys = spark.createDataFrame([(int(i),) for i in sorted(set(ids))], "doc_id long")
    wanted = sorted({r[0] for r in keys.select(_shard(F.col("doc_id"), shards)).collect()}) if shards else []
    there = set(names(spark, f"{path}/index"))
    folders = [f"{path}/index/{g}" for g in sorted({f"group={s // GROUP_SHARDS}" for s in wanted}) if g in there]
    out = "doc_id long, ids array<long>"
    if not folders:
        return spark.createDataFrame([], out)
    index = spark.read.schema(_INDEX).parquet(*folders).filter(F.col("shard").isin(wanted))
    entries: dict[int, list[tuple[int, int]]] = {}
    for r in _look_up(keys, index, shards).collect():  # at most one for each key asked for
        entries.setdefault(r["block"], []).append((r["doc_id"], r["place"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                b = Block(row)
                hit = [(k, p) for k, p in entries[row["block"]] if b.doc_ids[p] == k and not b.nulls[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in hit], pa.int64()),
                     pa.array([b.document(p).tolist() for _, p in hit], pa.list_(pa.int64()))], ["doc_id", "ids"])

    if not entries:
        return spark.createDataFrame([], out)
    return blocks_of(spark, path, list(entries)).mapInArrow(run, out)


def write_and_read_back(docs: DataFrame, **options) -> DataFrame:
    """Write the files to the shared folder, read every document back, and
    remove them once the result stands."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, **options)
    out = cut_lineage(read_token_files(spark, path))
    drop_path(spark, path)
    return out
