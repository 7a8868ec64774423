"""Fill-in-middle transformation (operator 11).

A text is stored as independent zstandard frames of about ``FRAME_BYTES`` with,
for each frame, the units, characters and bytes before it. Units are letter
runs (``[A-Za-z]+``) and single other characters; a run that goes on into the
next frame is counted in the one where it starts. Cuts are drawn in units from
a digest of the document's id; each is found by a binary search of the
cumulative units, and only its frame is decompressed. The output keeps all other
frames as they are: only the parts of cut frames, and the markers, are new ones.
Digests stream the frames in order. The text is rebuilt from output and form
alone: a scan finds the markers, and the parts between them go back in order.
One frame at a time is plain text in memory.

Forms: plain (the text as it is) if the text is empty, holds a marker (also
across frames) or is drawn so; else ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
(psm) or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm).

Cases: a null text counts as empty, a null id as the empty id; rows that share
an id share its draws; an empty table gives an empty table. Output columns
replace columns of the same name, everything else is kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import put, slices, work_name

FRAME_BYTES = 1 << 16
LEVEL = 1
MARKERS = (b"<P>", b"<S>", b"<M>")
PLAIN_PERCENT = 10   # of the documents stay plain
SPM_PERCENT = 20     # of the others are suffix first

_OTHER, _LETTER = 1, 2
_kinds = np.full(256, _OTHER, np.uint8)
_kinds[0x80:0xC0] = 0  # a byte inside a character
_kinds[np.r_[0x41:0x5B, 0x61:0x7B]] = _LETTER

_pack = zstandard.ZstdCompressor(level=LEVEL).compress
_unpack = zstandard.ZstdDecompressor().decompress


class Stored(NamedTuple):
    """A text in frames. ``units``, ``chars`` and ``sizes`` hold what is
    before each frame and, last, the totals."""
    data: list[bytes]
    units: list[int]
    chars: list[int]
    sizes: list[int]
    marked: bool


def unit_starts(part: bytes, in_run: bool) -> np.ndarray:
    """The bytes at which units start; ``in_run``: the part goes on behind a letter."""
    kind = _kinds[np.frombuffer(part, np.uint8)]
    letter = kind == _LETTER
    follows = np.empty(len(kind), bool)
    follows[:1] = in_run
    follows[1:] = letter[:-1]
    return np.flatnonzero((kind == _OTHER) | (letter & ~follows))


def _is_letter(byte: int) -> bool:
    return _kinds[byte] == _LETTER


def store(text: bytes, size: int = FRAME_BYTES) -> Stored:
    """Cut a text in UTF-8 into frames between characters."""
    data, units, chars, sizes = [], [0], [0], [0]
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and 0x80 <= text[end] < 0xC0:
            end += 1
        part = text[start:end]
        data.append(_pack(part))
        units.append(units[-1] + len(unit_starts(part, start > 0 and _is_letter(text[start - 1]))))
        chars.append(chars[-1] + int(np.count_nonzero(_kinds[np.frombuffer(part, np.uint8)])))
        sizes.append(end)
        start = end
    return Stored(data, units, chars, sizes, any(m in text for m in MARKERS))


class Cut(NamedTuple):
    frame: int   # the frame that the cut is in
    byte: int    # bytes of that frame before it
    chars: int   # characters of the text before it


def cut_at(s: Stored, unit: int, in_run: Callable[[int], bool]) -> Cut:
    """The place where unit number ``unit`` (from 0) starts, or the end of the
    text; decompresses one frame. ``in_run`` says whether a frame goes on
    behind a letter."""
    if unit >= s.units[-1]:
        return Cut(len(s.data), 0, s.chars[-1])
    frame = bisect_right(s.units, unit) - 1
    part = _unpack(s.data[frame])
    byte = int(unit_starts(part, in_run(frame))[unit - s.units[frame]])
    return Cut(frame, byte, s.chars[frame] + int(np.count_nonzero(_kinds[np.frombuffer(part[:byte], np.uint8)])))


def between(data: list[bytes], start: tuple[int, int], end: tuple[int, int]) -> list[bytes]:
    """The frames of the text from one (frame, byte) to another: whole frames
    as they are, parts of frames as new ones."""
    (f, a), (g, b) = start, end
    if f == g:
        return [_pack(_unpack(data[f])[a:b])] if a < b else []
    out = [_pack(_unpack(data[f])[a:])] if a else data[f:f + 1]
    out += data[f + 1:g]
    return out + ([_pack(_unpack(data[g])[:b])] if b else [])


def arrange(s: Stored, form: str, first: int, second: int) -> tuple[list[bytes], int | None, int | None]:
    """(frames of the output, characters of the prefix, of the middle) of a
    text whose prefix ends after ``first`` units, its middle after ``second``."""
    if form == "plain":
        return s.data, None, None

    def in_run(frame: int) -> bool:
        # only a frame that starts with a letter asks for the one before
        return frame > 0 and _is_letter(_unpack(s.data[frame])[0]) and _is_letter(_unpack(s.data[frame - 1])[-1])

    a, b = cut_at(s, first, in_run), cut_at(s, second, in_run)
    prefix = between(s.data, (0, 0), a[:2])
    middle, suffix = between(s.data, a[:2], b[:2]), between(s.data, b[:2], (len(s.data), 0))
    p, x, m = map(_pack, MARKERS)
    out = [p, *prefix, x, *suffix, m, *middle] if form == "psm" else [x, *suffix, p, *prefix, m, *middle]
    return out, a.chars, b.chars - a.chars


def plan(s: Stored, h1: int, h2: int, h3: int, h4: int) -> tuple[str, int, int]:
    """(form, units before the end of the prefix, of the middle) from the
    totals of a text and its draws; no frame is decompressed."""
    n = s.units[-1]
    if not n or s.marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        form = "plain"
    else:
        form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    return form, *sorted((h1 % (n + 1), h2 % (n + 1)))


def find_markers(data: list[bytes], markers: tuple[bytes, ...]) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """(start, end) of the first of each marker, in this order, as (frame,
    byte) places; also of markers that go over the edge of a frame."""
    out, tail, tail_at, frame = [], b"", [], 0
    while len(out) < len(markers) and frame < len(data):
        part = _unpack(data[frame])
        window, places = tail + part, len(tail)
        at = 0
        while len(out) < len(markers) and (k := window.find(markers[len(out)], at)) >= 0:
            at = k + len(markers[len(out)])
            out.append(tuple(tail_at[i] if i < places else (frame, i - places) for i in (k, at)))
        keep = max(at, len(window) - 2)
        tail_at = [tail_at[i] if i < places else (frame, i - places) for i in range(keep, len(window))]
        tail = window[keep:]
        frame += 1
    if len(out) < len(markers):
        raise ValueError("the output does not hold the markers of its form")
    return out


def restore(data: list[bytes], form: str) -> list[bytes]:
    """The frames of the text that an output of a form was made from."""
    if form == "plain":
        return data
    p, x, m = MARKERS
    (_, a0), (a1, b0), (b1, c0) = find_markers(data, (p, x, m) if form == "psm" else (x, p, m))
    one, two, middle = between(data, a0, a1), between(data, b0, b1), between(data, c0, (len(data), 0))
    return one + middle + two if form == "psm" else two + middle + one


def joined(data: list[bytes]) -> bytes:
    return b"".join(map(_unpack, data))


def digest(data: list[bytes]) -> str:
    """SHA-256 of the text of the frames, one frame after the other."""
    sha = hashlib.sha256()
    for frame in data:
        sha.update(_unpack(frame))
    return sha.hexdigest()


# ---- Spark -----------------------------------------------------------------

STORED = "struct<data:array<binary>,units:array<long>,chars:array<long>,sizes:array<long>,marked:boolean>"


def with_frames(df: DataFrame, text_col: str = "text", out_col: str = "frames") -> DataFrame:
    """Add ``out_col``: the text as a seekable store of frames."""
    size, longs = FRAME_BYTES, pa.list_(pa.int64())
    kind = pa.struct([("data", pa.list_(pa.binary())), ("units", longs), ("chars", longs), ("sizes", longs), ("marked", pa.bool_())])

    @F.arrow_udf(STORED)
    def stored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in slices((batch,)):
                made = [store(t or b"", size) for t in texts.cast(pa.binary()).to_pylist()]
                yield pa.StructArray.from_arrays([pa.array(list(col), f.type) for col, f in zip(zip(*made), kind)], fields=list(kind))

    return put(df, **{out_col: stored(F.col(text_col))})


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and key."""
    hex_ = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hex_, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", frames_col: str | None = None, seed: int = 1) -> DataFrame:
    """Add n (units), form, prefix_end and middle_end (units), prefix_chars and
    middle_chars (null if plain) and output: the frames of the transformed text,
    which :func:`frames_text` reads. Texts are stored on the way, or read from
    ``frames_col``, a column of :func:`with_frames`."""
    size = FRAME_BYTES
    longs = ("n", "prefix_end", "middle_end", "prefix_chars", "middle_chars")
    kind = pa.struct([*[(c, pa.int64()) for c in longs], ("form", pa.string()), ("output", pa.list_(pa.binary()))])

    @F.arrow_udf(f"struct<{''.join(f'{c}:long,' for c in longs)}form:string,output:array<binary>>")
    def arranged(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for first, *h in slices(batch):
                out = []
                for x, *numbers in zip((first if frames_col else first.cast(pa.binary())).to_pylist(), *(a.to_pylist() for a in h)):
                    s = Stored(**x) if frames_col else store(x or b"", size)
                    form, a, b = plan(s, *numbers)
                    output, prefix, middle = arrange(s, form, a, b)
                    out.append((s.units[-1], a, b, prefix, middle, form, output))
                yield pa.StructArray.from_arrays([pa.array(list(col), f.type) for col, f in zip(zip(*out), kind)], fields=list(kind))

    mark = work_name(df, "arranged")
    made = df.withColumn(mark, arranged(F.col(frames_col or text_col), *draws(F.col(id_col), seed)))
    return put(made, **{f.name: F.col(mark)[f.name] for f in kind}).drop(mark)


def _over_frames(result: str, kind: pa.DataType, of: Callable, *cols: Column) -> Column:
    """A column of ``of`` applied to the values of ``cols``, row by row."""
    @F.arrow_udf(result)
    def made(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in slices(batch):
                yield pa.array([of(*row) for row in zip(*(a.to_pylist() for a in part))], kind)

    # an iterator of one column would come without its tuple
    return made(*cols, *[F.lit(0)] * (len(cols) == 1))


def frames_text(frames: Column) -> Column:
    """The text of the frames."""
    return _over_frames("string", pa.string(), lambda data, _: joined(data).decode(), frames)


def restored_frames(frames: Column, form: Column) -> Column:
    """The frames of the text rebuilt from those of an output and its form."""
    return _over_frames("array<binary>", pa.list_(pa.binary()), restore, frames, form)


def digests(frames: Column, form: Column) -> Column:
    """output_sha256 and restored_sha256: lowercase hex SHA-256 of an output
    and of the text rebuilt from output and form."""
    kind = pa.struct([("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    return _over_frames("struct<output_sha256:string,restored_sha256:string>", kind,
                        lambda data, form: {"output_sha256": digest(data), "restored_sha256": digest(restore(data, form))}, frames, form)
