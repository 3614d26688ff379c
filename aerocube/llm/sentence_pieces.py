"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised here, by the longest prefix in the model's compiled character map, and each unit (a rule's match, or a
byte that stays) remembers how many bytes it had before and has after. The normalised text falls apart into runs of spaces with
what follows them: no piece holds a space after another character, so merges never cross these places and each distinct run is
encoded once by a task's table. The pieces' lengths, summed up, are places in the normalised text, and the units lead them
back to byte spans of the original. Tasks work on rows by themselves: nothing is shuffled.
"""

from __future__ import annotations

import codecs
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once, and characters that a task's table of runs holds before it starts anew.
CHUNK, TABLE = 2_000_000, 30_000_000
SPACE = "▁"
_RUN = re.compile(" +[^ ]*")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, data[at : at + size]
        at += size


def _message(number: int, data: bytes) -> bytes:
    """A field that holds a message."""
    size, out = len(data), bytes([number << 3 | 2])
    while size > 127:
        out, size = out + bytes([size & 127 | 128]), size >> 7
    return out + bytes([size]) + data


class CharacterMap:
    """The rules of a compiled character map: a double array of byte labels, whose leaves point to replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units, self.texts, self.first = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist(), compiled[4 + size :], {}

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << ((unit >> 6) & 8)

    def longest(self, data: bytes) -> tuple[int, str] | None:
        """Length and replacement of the longest rule that data begins with."""
        if not self.units:
            return None
        node, best = self._child(self.units[0]), None
        for n, byte in enumerate(data, 1):
            node ^= byte
            if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                break
            unit = self.units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                best = n, self.units[node] & 0x7FFFFFFF
        if not best:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])].decode()

    def starts(self, char: str) -> bool:
        """Whether some rule begins with the character."""
        if char not in self.first:
            node, found = self._child(self.units[0]) if self.units else 0, bool(self.units)
            for byte in char.encode():
                node ^= byte
                if not found or node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                    found = False
                    break
                node ^= self._child(self.units[node])
            self.first[char] = found
        return self.first[char]

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, int]]]:
        """The text with all rules applied from left to right, and for each match its place in the original, its bytes there
        and its bytes after."""
        heads = [c for c in set(text) if self.starts(c)]
        if not heads:
            return text, []
        out, matches, done, at = [], [], 0, 0
        for found in re.finditer("[" + "".join(map(re.escape, sorted(heads))) + "]", text):
            if found.start() < done:
                continue
            got = self.longest(text[found.start() : found.start() + 256].encode()[:256])
            if got is None:
                continue
            kept = text[done : found.start()]
            at += len(kept.encode())
            chars = len(text[found.start() : found.start() + got[0]].encode()[: got[0]].decode())
            out += [kept, got[1]]
            matches.append((at, got[0], len(got[1].replace(" ", SPACE).encode())))
            at, done = at + got[0], found.start() + chars
        return "".join([*out, text[done:]]), matches


class Model:
    """A model file of the kind that is supported, see encode()."""

    def __init__(self, data: bytes):
        import sentencepiece

        parts = [(k, v) for k, v in _fields(data)]
        trainer, normal = (dict(_fields(b"".join(v for k, v in parts if k == n))) for n in (2, 3))
        pieces = [dict(_fields(v)) for k, v in parts if k == 1]
        texts, kinds = [p[1].decode() for p in pieces], np.array([p.get(3, _NORMAL) for p in pieces])
        inner = any(SPACE in x.lstrip(SPACE) for x in texts)
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or not trainer.get(35, 0) or inner or not set(kinds.tolist()) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only BPE models with byte fallback, spaces at the beginning of pieces and no own symbols are supported")
        if not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("only normalisers that put a space first, keep spaces and escape them are supported")
        self.map = CharacterMap(normal.get(2, b""))
        # the library merges what is normalised here: its own normaliser is replaced by one that only escapes spaces
        plain = b"".join(_message(k, v) for k, v in parts if k != 3) + _message(3, b"\x18\x00\x20\x00\x28\x01")
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=plain)
        self.end = self.merges.eos_id()
        is_byte = kinds == _BYTE
        self.sizes = np.where(is_byte, 1, np.where(kinds == _CONTROL, 0, [len(x.encode()) for x in texts]))
        shown = [bytes([int(x[3:-1], 16)]) if b else b"" if k == _CONTROL else trainer.get(44, " ⁇ ".encode()) if k == _UNKNOWN else x.replace(SPACE, " ").encode() for x, b, k in zip(texts, is_byte, kinds, strict=True)]
        # and what each piece is at the beginning of a text, where the first space isn't the text's own
        first = [x if b or k != _NORMAL else x.removeprefix(b" ") for x, b, k in zip(shown, is_byte, kinds, strict=True)]
        self.shown, self.control = pa.array(shown + first, pa.binary()), kinds == _CONTROL


@functools.cache
def _model(path: str) -> Model:
    """Loaded once a worker."""
    with open(path, "rb") as f:
        return Model(f.read())


class _Runs(dict):
    """Numbers of the distinct runs that a task has met; `fresh` are those not yet encoded."""

    def __init__(self, model: Model):
        self.model, self.fresh, self.chars = model, [], 0
        self.first, self.values = np.zeros(1, "int64"), np.zeros(0, "<i4")

    def __missing__(self, run: str) -> int:
        code = self[run] = len(self)
        self.fresh.append(run)
        self.chars += len(run) + 60
        return code

    def encode_fresh(self) -> None:
        if self.fresh:
            got = self.model.merges.encode(self.fresh, num_threads=1)
            sizes = np.fromiter(map(len, got), "int64", len(got))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            self.values = np.concatenate([self.values, np.fromiter((i for x in got for i in x), "<i4", int(sizes.sum()))])
            self.fresh = []


def _units(text: str, matches: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit of a text its end when normalised, and its begin and end in the original. The space put first is a
    unit without bytes of its own."""
    data = np.frombuffer(text.encode(), "u1")
    after, begin = np.where(data == 32, 3, 1), np.arange(len(data))
    end, keep = begin + 1, np.ones(len(data), bool)
    for at, before, size in matches:  # a match is one unit, at its first byte
        after[at], end[at] = size, at + before
        keep[at + 1 : at + before] = False
    if matches:
        after, begin, end = after[keep], begin[keep], end[keep]
    return np.cumsum(np.concatenate([[3], after])), np.concatenate([[0], begin]), np.concatenate([[0], end])


def _encoded(texts: list[str], runs: _Runs, end_id: bool) -> list[list[np.ndarray]]:
    """Of each text its ids, begins and ends."""
    model, todo = runs.model, []
    for text in texts:
        plain, matches = model.map.apply(text)
        found = _RUN.findall(" " + plain.replace(SPACE, " ")) if plain else []
        todo.append((np.fromiter(map(runs.__getitem__, found), "int64", len(found)), matches))
    runs.encode_fresh()
    out = []
    for text, (codes, matches) in zip(texts, todo, strict=True):
        size = runs.first[codes + 1] - runs.first[codes]
        total = np.cumsum(size)
        ids = runs.values[np.repeat(runs.first[codes] - total + size, size) + np.arange(total[-1] if len(total) else 0)]
        places = np.cumsum(model.sizes[ids])
        ends, begin, end = _units(text, matches)
        begins, ends = begin[np.searchsorted(ends, places - model.sizes[ids], "right")], end[np.searchsorted(ends, places - 1, "right")]
        if end_id:
            ids, begins, ends = np.append(ids, model.end), np.append(begins, end[-1]), np.append(ends, end[-1])
        out.append([ids, begins, ends])
    return out


def encode(docs: DataFrame, id_: str, text: str, model_path: str, end_id: bool = True) -> DataFrame:
    """(id, ids, begins, ends; arrays of int) for each row of docs: what the sentencepiece library gives for the whole text, and
    of each piece the span of bytes (UTF-8) of the text that it stands for.

    model_path: a BPE model with byte fallback, the same file on every executor; other kinds are an error. Pieces that come from
    one match of the character map all span the match; the space that is put first spans nothing, as does the end id, which comes
    last if asked for; a piece for a byte spans this byte. Null and empty texts have no pieces but the end id; very long ones are
    encoded whole; repeated rows, ids and null ids stay, each with its pieces; no ties arise; an empty table gives no rows; other
    columns, of any name, don't matter. A very common run is only looked up; the table of a task is bounded, as is the text
    that it works on at once (a single text apart).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        runs = _Runs(model)
        for batch in batches:
            texts = batch.column("text")
            ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype("int64"))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, "right")))
                got = _encoded([x or "" for x in texts.slice(a, b - a).to_pylist()], runs, end_id)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x[0]) for x in got])]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), pa.int32())) for x in zip(*got, strict=True)]
                yield pa.record_batch([batch.column("id").slice(a, b - a), *lists], ["id", "ids", "begins", "ends"])
                a = b
                if runs.chars > TABLE:
                    runs = _Runs(model)

    kind = docs.schema[id_].dataType.simpleString()
    rows = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, f"id {kind}, ids array<int>, begins array<int>, ends array<int>").withColumnRenamed("id", id_)


def _one_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_each", _one_each)


def decode(ids: Column, model_path: str) -> Column:
    """What the sentencepiece library decodes ids (array<int>) to: pieces put together, without the space that was put first;
    control ids give nothing, bytes that aren't UTF-8 a replacement character each. Null and empty ids give an empty text, a null id
    among them nothing; one that the model doesn't have is an error."""

    def some(column: pa.Array, model: Model) -> pa.Array:
        rows = np.repeat(np.arange(len(column)), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
        flat = pc.fill_null(column.flatten(), model.end).to_numpy(zero_copy_only=False)
        shown = ~model.control[flat]
        rows, flat = rows[shown], flat[shown].astype("int64")
        leads = np.ones(len(rows), bool)
        leads[1:] = rows[1:] != rows[:-1]
        flat[leads] += len(model.control)
        offsets = pa.array(np.searchsorted(rows, np.arange(len(column) + 1)), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, model.shown.take(pa.array(flat))), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "one_each") for x in joined.to_pylist()], pa.string())

    @F.arrow_udf("string")
    def work(column: pa.Array) -> pa.Array:
        model, out, a = _model(model_path), [pa.array([], pa.string())], 0
        ends = np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False), dtype="int64")
        while a < len(column):  # some ids at once
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK // 4, "right")))
            out.append(some(column.slice(a, b - a), model))
            a = b
        return pa.concat_arrays(out)

    return work(ids)


def op13_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    got = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", path)
    return got.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
