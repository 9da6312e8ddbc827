"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file holds a base64 token and its rank per line. A text is split by the
vocabulary's pattern and each match is merged on its own, without special
tokens. Texts longer than a chunk are first cut at boundaries that the
pattern always splits at, whatever stands around them, so the chunks' ids put
together are the ids of the whole text, and the library never holds more than
a chunk (or one match, if that is longer). The ids are kept packed, as
little-endian unsigned 32-bit integers, the form training shards store.
Decoding joins the tokens' raw bytes, so it gives back every text's bytes, also where a
token ends within a character.

Both directions are one pass over the rows: nothing is shuffled, nothing
grows with a key, and a task holds one slice of a batch (or one longer text) at a time.

Defined cases: null text is empty (no ids, empty packed bytes); bytes that are
no UTF-8 count as U+FFFD; null packed ids decode to null; an id that the rank
file lacks and packed bytes that are no whole number of ids fail the job; repeated rows each get a row; an empty table gives an empty
result; other columns are kept, those named like a result column give way.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.tables import once_per_process
from catalog_sync.llm.tokens import text_batches

CHUNK = 1 << 16

#: Letters, digits and other signs whose kind is the same in every Unicode version, so that this module and
#: the library, which may know different versions, agree on them.
_LETTER, _DIGIT = "A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3", "0-9"
_SIGN = "!-&(-/:-@\\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"  # without the apostrophe, which may belong to the letters after it

#: Places where every pattern of this family (contractions, letters, digits, other signs, each with at most
#: one leading space, and white space of its own) ends a match, and where cutting changes no match beside it:
#: before white space that follows something else, between signs of different kinds, and before the last of
#: several white spaces, if something else follows it.
SAFE = (r"(?<=\P{White_Space})(?=\p{White_Space})"
        rf"|(?<=[{_LETTER}])(?=[{_DIGIT}{_SIGN}'])|(?<=[{_DIGIT}])(?=[{_LETTER}{_SIGN}'])|(?<=[{_SIGN}])(?=[{_LETTER}{_DIGIT}])"
        r"|(?<=\p{White_Space})(?=\p{White_Space}\P{White_Space})")
_BLANK = regex.compile(r"\p{White_Space}+")
_FORWARD, _BACKWARD = regex.compile(SAFE), regex.compile("(?r)" + SAFE)


def chunks(text: str, most: int = CHUNK) -> Iterator[str]:
    """Parts of ``text`` of at most ``most`` characters, cut at safe boundaries; longer only where there is none."""
    at = 0
    while len(text) - at > most:
        cut = _BACKWARD.search(text, at + 1, at + most) or _FORWARD.search(text, at + most)
        # a search that ends within the text doesn't see what follows, so a boundary there is none it finds
        if cut is None or cut.start() >= len(text):
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Codec:
    """A rank file with its pattern, loaded once in each Python worker."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.one_match = tiktoken.Encoding("one match", pat_str="(?s:.+)", mergeable_ranks=table, special_tokens={})

    @classmethod
    def of(cls, ranks: str, pattern: str) -> Codec:
        return once_per_process(f"bpe:{ranks}:{pattern}", lambda: cls(ranks, pattern))

    def encode(self, text: str, most: int = CHUNK) -> bytes:
        return b"".join(self._ids(part, most) for part in chunks(text, most))

    def _ids(self, part: str, most: int) -> bytes:
        # white space without a boundary is one match; the library's look-ahead can't go back over millions of signs
        library = self.one_match if len(part) > most and _BLANK.fullmatch(part) else self.library
        return library.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes()

    def decode(self, packed: bytes, most: int = CHUNK) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        return b"".join(self.library.decode_bytes(ids[at : at + most].tolist()) for at in range(0, len(ids), most))


def _mapped(rows: DataFrame, source: str, target: str, convert, n: str | None = None) -> DataFrame:
    """``rows`` with ``target`` made from the binary form of ``source`` (and its length in ids, ``n``)."""
    taken = {source.lower(), target.lower(), *([n.lower()] if n else [])}
    rest = [c for c in rows.columns if c.lower() not in taken]
    keep = [rows.schema[c] for c in rest] + [rows.schema[source]] * (source.lower() != target.lower())
    schema = T.StructType([*keep, T.StructField(target, T.BinaryType()), *([T.StructField(n, T.LongType())] if n else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = convert()
        for batch in text_batches(batches):
            column = batch.column(len(rest))
            raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary())
            out = [change(x.as_py()) for x in raw]
            made = [pa.array(out, pa.binary())] + ([pa.array([len(x) // 4 for x in out], pa.int64())] if n else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return rows.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{source}`")).mapInArrow(run, schema)


def encode_texts(docs: DataFrame, ranks: str, pattern: str, *, text: str = "text", ids: str = "ids", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the packed token ids of their whole texts (binary ``ids``) and ``n_tokens``."""

    def convert():
        codec = Codec.of(ranks, pattern)
        return lambda raw: codec.encode((raw or b"").decode("utf-8", "replace"), chunk)

    return _mapped(docs, text, ids, convert, "n_tokens")


def decode_ids(rows: DataFrame, ranks: str, pattern: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the raw bytes that their packed ids stand for (binary ``decoded``)."""

    def convert():
        codec = Codec.of(ranks, pattern)
        return lambda packed: None if packed is None else codec.decode(packed)

    return _mapped(rows, ids, decoded, convert)


def hex_digest(packed: Column) -> Column:
    """Lower-case hex SHA-256 of a binary column."""
    return F.sha2(packed, 256)
