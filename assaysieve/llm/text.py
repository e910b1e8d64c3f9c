"""Words, digests and Arrow column functions that the text operators share."""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Texts are handed to the row functions in pieces of about this many bytes, so that a task holds no more; a single text is never cut.
PIECE_BYTES = 2_000_000

_LETTERS = {**{c: c + 32 for c in range(0x41, 0x5B)}, **{c: c for c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]}}
# Bytes of UTF-8: A-Z to a-z, digits, letters and everything beyond ASCII unchanged, the rest to blanks.
FOLD = bytes(_LETTERS.get(c, 0x20) for c in range(256))
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def space_words(text: str | None) -> list[bytes]:
    """Words between blanks and the controls 09 to 0D, unchanged; none for null."""
    return [] if text is None else text.encode().split()


def folded_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case; none for null."""
    return [] if text is None else text.encode().translate(FOLD).split()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, cut between texts so that a piece stays small; at least one text in each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        end = max(int(np.searchsorted(ends, done + PIECE_BYTES, "right")), at + 1)
        yield texts.slice(at, end - at)
        at = end


def per_text(make: Callable[[], Callable[[list[str | None]], list[tuple]]], schema: str) -> Callable[..., Column]:
    """A column function from a text to a struct.

    `make` runs once per task and returns a function from a list of texts to as many tuples, whose attribute `done`, if it has one, is
    called at the task's end. The other columns of the frame stay in the JVM, so their names and types do not matter.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows_of = make()
        for batch in batches:
            for piece in pieces(batch):
                rows = rows_of(piece.to_pylist())
                yield pa.StructArray.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], fields=list(fields))
        getattr(rows_of, "done", bool)()

    return arrow_udf(run, returnType=StructType.fromDDL(schema))
