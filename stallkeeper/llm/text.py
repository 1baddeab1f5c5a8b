"""Text rules that several operators share."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Only A-Z are lower-cased; other capitals are left as they are.
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

# What separates words: ASCII other than digits and letters.  Everything beyond ASCII belongs to a word.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The same rule on UTF-8 bytes: capitals to small letters, separators to spaces.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x80 and not chr(b).isalnum() else b for b in range(256)
)


# Letters and digits that `regex` knows and the tokenizers' library does not, from and to; and
# capitals that the library lower-cases and Python does not, with how far the small letter is away.
NEWER = (
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f),
    (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2),
    (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7),
    (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1),
    (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3),
    (0x16ff2, 0x16ff3), (0x16ff4, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20),
    (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168),
    (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff),
    (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4),
    (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479),
    (0x3d000, 0x3fc3f),
)
NEWER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)


def newer_characters() -> str:
    """:data:`NEWER` as ranges of a character class."""
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER)


_newer = frozenset(chr(c) for a, b in NEWER for c in range(a, b + 1))
_beyond = re.compile(f"[{chr(NEWER[0][0])}-{chr(0x10FFFF)}]").search


def has_newer(text: str) -> bool:
    """Whether a text holds one of :data:`NEWER`; texts below the first of them are told in one look."""
    return _beyond(text) is not None and not _newer.isdisjoint(text)


_has_newer_capital = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in NEWER_CAPITALS) + "]").search
_newer_small = {c: c + away for a, b, away in NEWER_CAPITALS for c in range(a, b + 1)}


def lower_as_library(text: str) -> str:
    """Small letters as the tokenizers' library has them: the capital sigma without a look at what follows it."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(_newer_small) if _has_newer_capital(text) else text


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_bytes(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, lower-cased; null has none."""
    return text.translate(_BYTES).split() if text else []


def carried(docs: DataFrame, carry: list[str] | None, text_col: str) -> DataFrame:
    """``row``, a struct of the columns to carry (all by default), and ``text`` as bytes unless a row holds it."""
    names = docs.columns if carry is None else carry
    row = F.struct(*[docs[c] for c in names]).alias("row")
    return docs.select(row) if text_col in names else docs.select(row, docs[text_col].cast("binary").alias("text"))


def carried_texts(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of rows that :func:`carried` made, as bytes."""
    held = batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text_col)
    return held.cast(pa.binary())


@dataclass(frozen=True)
class CutTexts:
    """Words of some texts, as numbers of distinct ones: ``words[number]`` is a word's bytes.

    ``doc`` is the place of the text that a word is in; ``piece`` differs for words between which a
    text or a piece of it ends.
    """

    words: pa.Array
    number: np.ndarray
    doc: np.ndarray
    piece: np.ndarray


class Bytes:
    """What the bytes of UTF-8 texts are: in a word (A-Z in lower case), between words, or the end of a piece."""

    def __init__(self, in_word: Callable[[int], bool], ends: bytes = b"") -> None:
        self.lower = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
        self.ends = np.array([b in ends for b in range(256)])
        self.in_word = np.array([in_word(b) and b not in ends for b in range(256)])


def cut_texts(texts: pa.Array, rule: Bytes) -> CutTexts:
    """Cut texts (as bytes, null as empty) into words, all at once."""
    texts = pc.fill_null(texts, b"") if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    borders = (offsets - offsets[0]).astype(np.int64)
    inside = rule.in_word[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    firsts = borders[:-1][borders[:-1] < borders[1:]]
    before[firsts] = False
    after[borders[1:][borders[:-1] < borders[1:]] - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=places[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(rule.lower[data[inside]])])
    coded = words.dictionary_encode()
    doc = np.searchsorted(borders, starts, side="right") - 1
    ended = np.cumsum(rule.ends[data])
    return CutTexts(coded.dictionary, coded.indices.to_numpy(), doc, ended[starts] + doc)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows of about ``most`` units in all; a larger row stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
