"""BPE encoding and decoding with a table of distinct words.

Words are runs between ASCII white space, split by Spark; the tokenizer drops white space and never looks across it, so a
word's ids don't depend on its neighbours. Documents are packed into blocks of some megabytes of text: a block holds its
distinct words once, dealt into PARTS lists by their hash, and each position as a number among them. The lists meet, by
part, in a table of distinct words that lies spread over tasks; each word is encoded there once, and the ids of each list go
back to its block and so to each position. For decoding, the ids that a block holds are joined to the tokenizer's pieces,
and the pieces go to each position like the ids. Words, numbers and ids travel compressed, so all of it moves less than the texts.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import all_but, bucket_table

#: Bytes of text in a block, lists that its words are dealt into, and blocks that share one table of distinct words (64 GB of
#: text): so a list has some hundred words and a task some million, whatever the size of the corpus or cluster.
BLOCK, PARTS, SHARING = 16_000_000, 256, 4096
#: Words that a task's table holds before it starts a new one, and words that are encoded at once.
TABLE, FEW = 2_000_000, 1_000
RARE = 255
WHITE = " \t\n\x0b\x0c\r"


@functools.cache
def _tokenizer(path: str):
    """Loaded once a worker. Its own threads stay off: Spark's tasks already take all cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def checked_pieces(path: str) -> list[tuple[int, str]]:
    """(id, piece) of a tokenizer; an error if words can't be encoded by themselves or decoding is more than a join."""
    tokenizer = _tokenizer(path)
    added = tokenizer.get_added_tokens_decoder().values()
    if tokenizer.decoder is not None:
        raise ValueError(f"{path} has a decoder; only pieces joined by spaces are supported")
    one = tokenizer.encode("ab1", add_special_tokens=False).ids
    apart = all(tokenizer.encode(f"{c}ab1{c}{c}ab1{c}", add_special_tokens=False).ids == one * 2 for c in WHITE)
    if not apart or any(c.isspace() for token in added for c in token.content):
        raise ValueError(f"{path} keeps white space; only tokenizers that drop it are supported")
    return sorted((i, piece) for piece, i in tokenizer.get_vocab(with_added_tokens=True).items())


def _zip(data: bytes, level: int = 3) -> bytes:
    return zstandard.compress(data, level)


def _unzip(data: bytes) -> bytes:
    return zstandard.decompress(data)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as all their first bytes, all their second ones and so on, which packs well."""
    return numbers.astype("<i4").view("u1").reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(4, -1).T).view("<i4").ravel()


class _Block:
    """Documents' words, and what they become when they are packed."""

    def __init__(self):
        self.rows, self.lens, self.words, self.size = [], [], [], 0

    def add(self, rows: pa.Array, words: pa.ListArray) -> None:
        flat = words.flatten()
        self.rows += rows.to_pylist()
        self.lens += np.asarray(pc.list_value_length(words)).tolist()
        self.words.append(flat)
        self.size += pc.sum(pc.binary_length(flat)).as_py() or 0

    def packed(self, number: int, kind: pa.DataType) -> pa.RecordBatch:
        """Words are listed part by part and numbered so. Each position is a byte: a place in `top`, the numbers of the most
        frequent words, or RARE, for which the next number of `rare` stands."""
        found = pa.concat_arrays(self.words).dictionary_encode()
        codes, names = np.asarray(found.indices), found.dictionary.cast(pa.binary()).to_pylist()
        part = np.fromiter((xxhash.xxh3_64_intdigest(w) % PARTS for w in names), "int64", len(names))
        by_part = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[by_part], np.arange(PARTS + 1))
        order = [i for a, b in zip(cut[:-1], cut[1:], strict=True) for i in sorted(by_part[a:b].tolist(), key=names.__getitem__)]
        place = np.empty(len(order), "<i4")
        place[order] = np.arange(len(order))
        top = np.argsort(-np.bincount(codes, minlength=len(order)), kind="stable")[:RARE]
        short = np.full(len(order), RARE, "u1")
        short[top] = np.arange(len(top))
        short = short[codes] if order else np.zeros(0, "u1")
        lists = [{"part": p, "words": _zip(b" ".join([names[i] for i in order[a:b]]), 9)} for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        columns = {"block": pa.array([number], pa.int64()), "rows": pa.array([self.rows], pa.list_(kind)), "lens": pa.array([self.lens], pa.list_(pa.int32()))}
        packed = {"codes": short.tobytes(), "rare": _planes(place[codes[short == RARE]]), "top": place[top].tobytes()}
        columns |= {k: pa.array([_zip(x)], pa.binary()) for k, x in packed.items()}
        return pa.record_batch(columns | {"lists": pa.array([lists], pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())])))})


def pack_blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of docs (row, words). A text over `size` is in one block with those before it; none is cut."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, kind = TaskContext.get().partitionId() << 32, _Block(), pa.null()
        for batch in batches:
            kind = batch.schema.field("row").type
            ends = np.cumsum(np.asarray(pc.list_value_length(batch.column("words")), dtype="int64"))
            a = 0
            while a < batch.num_rows:  # some hundred thousand words at once
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 500_000, "right")))
                block.add(batch.column("row").slice(a, b - a), batch.column("words").slice(a, b - a))
                a = b
                if block.size >= size:
                    yield block.packed(number, kind)
                    number, block = number + 1, _Block()
                    pa.default_memory_pool().release_unused()
        if block.rows:
            yield block.packed(number, kind)
        del block
        pa.default_memory_pool().release_unused()  # workers stay for what comes next

    row = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(pack, f"block long, rows array<{row}>, lens array<int>, codes binary, rare binary, top binary, lists array<struct<part: int, words: binary>>")


def _encode_lists(tokenizer_path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table, of = _tokenizer(tokenizer_path), {}, None
        for batch in batches:
            answers = []
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("words"), strict=True):
                words = _unzip(packed.as_py()).split(b" ")
                if part != of:  # rows come part by part, and parts share no words
                    table, of = {}, part
                if fresh := [w for w in words if w not in table]:
                    if len(table) > TABLE:
                        table, fresh = {}, words
                    for a in range(0, len(fresh), FEW):
                        found = tokenizer.encode_batch_fast([w.decode() for w in fresh[a : a + FEW]], add_special_tokens=False)
                        table.update((w, np.array(x.ids, "<i4").tobytes()) for w, x in zip(fresh[a : a + FEW], found, strict=True))
                ids = [table[w] for w in words]
                sizes = np.fromiter(map(len, ids), "<i4", len(ids)) // 4
                answers.append(_zip(np.array([len(ids)], "<i4").tobytes() + sizes.tobytes() + b"".join(ids)))
            yield pa.record_batch([batch.column("block"), batch.column("part"), pa.array(answers, pa.binary())], ["block", "part", "ids"])

    return work


def _split(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and ids of the words of a block's lists."""
    got = [np.frombuffer(_unzip(x), "<i4") for x in packed]
    none = np.zeros(0, "<i4")
    return np.concatenate([g[1 : 1 + g[0]] for g in got] or [none]), np.concatenate([g[1 + g[0] :] for g in got] or [none])


def _used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, used): the distinct ids of a block."""
    for batch in batches:
        used = [np.unique(_split(x)[1]) for x in batch.column("ids").to_pylist()]
        yield pa.record_batch([batch.column("block"), pa.array(used, pa.list_(pa.int32()))], ["block", "used"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, ids, decoded) from blocks with the ids of their words and the pieces of their ids."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            size, values = _split(one.column("ids")[0].as_py())
            pieces = one.column("pieces").flatten()
            known, piece = np.asarray(pieces.field("id")), pieces.field("piece")
            by_id = np.argsort(known)
            at = np.searchsorted(known, values, sorter=by_id)
            at = by_id[at] if len(at) else at
            first = np.concatenate([[0], np.cumsum(size, dtype="int64")])
            short, rare, top = (_unzip(one.column(c)[0].as_py()) for c in ("codes", "rare", "top"))
            short, top = np.frombuffer(short, "u1"), np.frombuffer(top, "<i4")
            codes = np.zeros(len(short), "<i4")
            codes[short == RARE] = _from_planes(rare)
            codes[short != RARE] = top[short[short != RARE]]
            ends = np.concatenate([[0], np.cumsum(np.asarray(one.column("lens").flatten()), dtype="int64")])
            rows = one.column("rows").flatten()
            a = 0
            while a < len(rows):  # some words at once
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + 250_000, "right")) - 1)
                c = codes[ends[a] : ends[b]]
                n = size[c]
                total = np.concatenate([[0], np.cumsum(n, dtype="int64")])
                flat = np.repeat(first[c] - total[:-1], n) + np.arange(total[-1]) if len(c) else np.zeros(0, "int64")
                offsets = pa.array(total[ends[a : b + 1] - ends[a]], pa.int32())
                texts = pa.ListArray.from_arrays(offsets, piece.take(pa.array(at[flat])) if len(flat) else pa.array([], pa.string()))
                ids = pa.ListArray.from_arrays(offsets, pa.array(values[flat], pa.int32()))
                yield pa.record_batch({"row": rows.slice(a, b - a), "ids": ids, "decoded": pc.binary_join(texts, " ")})
                a = b


def encode(docs: DataFrame, id_: str, text: str, tokenizer_path: str, block: int = BLOCK) -> DataFrame:
    """(id, ids array<int>, decoded) for each row of docs: what the tokenizer gives for the whole text, without added
    tokens, and what it decodes the ids to.

    tokenizer_path: a JSON file of the tokenizers library, the same on every executor; an error unless its pre-tokenizer
    drops white space and it has no decoder. Null and empty texts have no ids and decode to an empty text; very long ones
    are in one block; repeated rows and ids stay, each with its ids; other columns, of any name, don't matter; an empty
    table gives no rows. Blocks are written to the shared folder once, so block numbers hold when executors are lost.
    They and their ids lie there in buckets, as tables until common.free() drops them. A word is in a block once, so a very common word is no
    more than a place in a row per block.
    """
    spark = docs.sparkSession
    pieces = F.broadcast(spark.createDataFrame(checked_pieces(tokenizer_path), "id int, piece string"))  # a fixed table
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    # buckets of blocks, so that the ids come to where the codes lie and the codes aren't shuffled
    blocks = bucket_table(pack_blocks(docs.select(F.col(id_).alias("row"), words.alias("words")), block), "block")
    asked = blocks.select("block", F.explode("lists").alias("x")).select("block", "x.part", "x.words")
    sharing = F.pmod(F.xxhash64("block"), F.lit(blocks.count() // SHARING + 1))
    answers = asked.repartition("part", sharing).sortWithinPartitions("part", sharing).mapInArrow(_encode_lists(tokenizer_path), "block long, part int, ids binary")
    answers = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("got")).select("block", F.col("got.ids").alias("ids"))
    answers = bucket_table(answers, "block")  # read twice, and by block
    used = answers.mapInArrow(_used, "block long, used array<int>").select("block", F.explode("used").alias("id"))
    read = used.join(pieces, "id").groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))
    joined = blocks.drop("lists").join(answers, "block", "left").join(read, "block", "left")
    joined = joined.select("rows", "lens", "codes", "rare", "top", F.coalesce("ids", F.array().cast("array<binary>")).alias("ids"), F.coalesce("pieces", F.array().cast("array<struct<id:int,piece:string>>")).alias("pieces"))
    kind = docs.schema[id_].dataType.simpleString()
    return joined.mapInArrow(_unpack, f"row {kind}, ids array<int>, decoded string").withColumnRenamed("row", id_)


def decode(encoded: DataFrame, ids: str, tokenizer_path: str) -> DataFrame:
    """encoded with the column `decoded`: the pieces of the ids, joined by spaces; one of that name is replaced.

    Each distinct sequence of ids is decoded once, by a join of its ids to the tokenizer's pieces, which puts a row per id
    through a shuffle; encode() gives the same for its own ids at the cost of a row per block and id. An id without a piece
    gives nothing; null and empty ids give an empty text; very long ones are decoded whole. Repeated rows and other
    columns, of any name, stay; an empty table gives no rows.
    """
    pieces = F.broadcast(encoded.sparkSession.createDataFrame(checked_pieces(tokenizer_path), "id int, piece string"))
    key = F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).alias("ids"), key.alias("key"))
    each = rows.select("key", "ids").dropDuplicates(["key"]).select("key", F.posexplode("ids").alias("at", "id"))
    texts = each.join(pieces, "id").groupBy("key").agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "piece")))["piece"], " ").alias("decoded"))
    return rows.join(texts, "key", "left").select(*all_but("row", encoded, "decoded"), F.coalesce("decoded", F.lit("")).alias("decoded"))


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    got = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", path)
    return got.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
