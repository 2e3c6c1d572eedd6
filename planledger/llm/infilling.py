"""Fill-in-middle transformation over seekable compressed frames.

``frame_texts`` stores each text as independent zstandard frames of up to ``units`` code
points, with the cumulative number of code points before each frame, so that any stretch
of a text can be read without what lies before it. ``fill_in_middle`` takes the two cuts
of a document from its key alone, decompresses only the frames that hold a cut to split
them there, and puts the frames into the output's order. Whole frames move as they are,
never decompressed; the marks and the parts of cut frames become frames of their own. So
the output is seekable too. Digests stream over its frames in order, one at a time; the text
is restored from output and form alone, by finding the marks while streaming and then
streaming the three parts in the text's order.

A document's row holds all its frames, so nothing is shuffled. A document is left plain
if its text is empty or holds a mark, or by its key's hash. Null texts count as empty.
A null key hashes as an empty number, so such rows share their cuts' hashes. Rows that
repeat are transformed each. Extra columns stay, all but the text; columns named as the
operator's own are replaced. Bytes that are no UTF-8 are kept as they are, one unit each.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Code points of a frame.
UNITS = 1 << 14
# The marks and the shares of the forms, in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED, SPM = 90, 20
_FRAMES = "array<struct<first: long, units: long, data: binary>>"
_KIND = pa.list_(pa.struct([("first", pa.int64()), ("units", pa.int64()), ("data", pa.binary())]))
Frame = tuple[int, int, bytes]  # first unit, units, compressed text


class Frames:
    """Compresses and reads frames; one per task."""

    def __init__(self, level: int = 3) -> None:
        self._write = zstandard.ZstdCompressor(level=level).compress
        self._read = zstandard.ZstdDecompressor().decompress

    def write(self, text: str) -> bytes:
        return self._write(text.encode("utf-8", "surrogateescape"))

    def read(self, data: bytes) -> str:
        return self._read(data).decode("utf-8", "surrogateescape")

    def cut(self, text: str, units: int) -> list[Frame]:
        return [(low, min(units, len(text) - low), self.write(text[low : low + units])) for low in range(0, len(text), units)]

    def placed(self, parts: list[tuple[int, bytes]]) -> list[Frame]:
        """Frames of (units, data) with what lies before each."""
        out, first = [], 0
        for units, data in parts:
            out.append((first, units, data))
            first += units
        return out

    def split(self, frames: list[Frame], at: int) -> list[Frame]:
        """The same text with a frame border at unit ``at``: only the frame that holds it is read."""
        k = bisect_right(frames, at, key=lambda f: f[0]) - 1
        if k < 0 or at == frames[k][0] or at >= frames[k][0] + frames[k][1]:
            return frames
        first, units, data = frames[k]
        text = self.read(data)
        left, right = text[: at - first], text[at - first :]
        return [*frames[:k], (first, at - first, self.write(left)), (at, units - (at - first), self.write(right)), *frames[k + 1 :]]

    def digest(self, frames: list[Frame]) -> str:
        sha = hashlib.sha256()
        for _, _, data in frames:
            sha.update(self._read(data))
        return sha.hexdigest()

    def find(self, frames: list[Frame], marks: tuple[str, ...]) -> dict[str, int]:
        """The unit at which each mark first stands, in one stream that keeps a frame and a few characters."""
        found: dict[str, int] = {}
        tail = ""
        for first, _, data in frames:
            window, begin = tail + self.read(data), first - len(tail)
            for mark in marks:
                if mark not in found and (at := window.find(mark)) >= 0:
                    found[mark] = begin + at
            tail = window[-(max(map(len, marks)) - 1) :]
        return found


def hash_parts(key: object) -> list[int]:
    """Four numbers of 32 bits from a document's key."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def choose(key: object, units: int, marked: bool) -> tuple[str, int | None, int | None]:
    """(form, units of the prefix, units of the middle) of a document."""
    h1, h2, h3, h4 = hash_parts(key)
    if not units or marked or h3 % 100 >= TRANSFORMED:
        return "plain", None, None
    low, high = sorted((h1 % (units + 1), h2 % (units + 1)))
    return ("spm" if h4 % 100 < SPM else "psm"), low, high - low


def rearranged(frames: list[Frame], form: str, prefix: int | None, middle: int | None, io: Frames) -> list[Frame]:
    """The frames of the output."""
    if form == "plain":
        return frames
    end = prefix + middle
    frames = io.split(io.split(frames, prefix), end)
    one = bisect_right(frames, prefix - 1, key=lambda f: f[0])
    two = bisect_right(frames, end - 1, key=lambda f: f[0])
    parts = {PREFIX: frames[:one], MIDDLE: frames[one:two], SUFFIX: frames[two:]}
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    return io.placed([x for mark in order for x in [(len(mark), io.write(mark)), *((u, d) for _, u, d in parts[mark])]])


def restored(output: list[Frame], form: str, io: Frames) -> list[Frame]:
    """The frames of the text, from the output and its form."""
    if form == "plain":
        return output
    total = output[-1][0] + output[-1][1]
    at = io.find(output, (PREFIX, SUFFIX, MIDDLE))
    for mark, place in at.items():
        output = io.split(io.split(output, place), place + len(mark))
    places = sorted(at.values()) + [total]
    out = []
    for mark in (PREFIX, MIDDLE, SUFFIX):
        begin, end = at[mark] + len(mark), places[places.index(at[mark]) + 1]
        low, high = (bisect_right(output, x - 1, key=lambda f: f[0]) for x in (begin, end))
        out += [(u, d) for _, u, d in output[low:high]]
    return io.placed(out)


def frame_texts(docs: DataFrame, text: str = "text", units: int = UNITS) -> DataFrame:
    """Replace the text by ``frames``, ``n`` (its code points) and ``marked`` (whether it holds a mark)."""
    rest = [f for f in docs.schema if f.name not in (text, "frames", "n", "marked")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        io = Frames()
        for batch in batches:
            frames, sizes, marked = [], [], []
            for value in batch.column(len(rest)):
                own = (value.as_py() or b"").decode("utf-8", "surrogateescape")
                frames.append(io.cut(own, units))
                sizes.append(len(own))
                marked.append(any(mark in own for mark in (PREFIX, SUFFIX, MIDDLE)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], _arrow(frames), pa.array(sizes, pa.int64()), pa.array(marked, pa.bool_())],
                names=[*batch.schema.names[: len(rest)], "frames", "n", "marked"],
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"frames {_FRAMES}, n long, marked boolean"]
    return docs.select(*[f"`{f.name}`" for f in rest], F.col(text).cast("binary").alias("__text")).mapInArrow(cut, ", ".join(kinds))


def _arrow(frames: list[list[Frame]]) -> pa.Array:
    return pa.array([[{"first": a, "units": b, "data": c} for a, b, c in row] for row in frames], _KIND)


def fill_in_middle(framed: DataFrame, key: str = "doc_id", keep_output: bool = True) -> DataFrame:
    """What ``frame_texts`` gives, with its frames replaced by form, prefix_chars, middle_chars,
    the sha256 of the output and of the text restored from it and, with ``keep_output``, the
    output's ``frames``."""
    own = ("frames", "marked", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    rest = [f for f in framed.schema if f.name not in own]
    at = [f.name for f in rest].index(key)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        io = Frames()
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            n = batch.column(batch.schema.get_field_index("n"))
            for doc, units, marked, row in zip(batch.column(at), n, batch.column(len(rest)), batch.column(len(rest) + 1), strict=True):
                frames = [(f["first"], f["units"], f["data"]) for f in row.as_py()]
                form, prefix, middle = choose(doc.as_py(), units.as_py(), marked.as_py())
                output = rearranged(frames, form, prefix, middle, io)
                back = restored(output, form, io)
                found = (form, prefix, middle, io.digest(output), io.digest(back), output if keep_output else None)
                for column, value in zip(columns, found, strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [*batch.columns[: len(rest)], *(pa.array(x, kind) for x, kind in zip(columns, kinds, strict=False))]
            names = [*batch.schema.names[: len(rest)], *own[2:]]
            if keep_output:
                arrays.append(_arrow(columns[5]))
                names.append("frames")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    kinds += ["form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"]
    kinds += [f"frames {_FRAMES}"] * keep_output
    return framed.select(*[f"`{f.name}`" for f in rest], "marked", "frames").mapInArrow(transform, ", ".join(kinds))


def frame_text(frames: list[Frame]) -> str:
    """The text of a row of frames."""
    io = Frames()
    return "".join(io.read(data) for _, _, data in frames)


#: The same over ``documents`` as SQL.
INFILLING_SQL = """
WITH own AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
hashed AS (SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM own),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
                  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
written AS (SELECT *, CASE form WHEN 'plain' THEN t
                  WHEN 'psm' THEN '<P>' || substring(t, 1, p) || '<S>' || substring(t, q + 1) || '<M>' || substring(t, p + 1, q - p)
                  ELSE '<S>' || substring(t, q + 1) || '<P>' || substring(t, 1, p) || '<M>' || substring(t, p + 1, q - p) END AS out
            FROM formed),
marked AS (SELECT *, strpos(out, '<P>') AS a, strpos(out, '<S>') AS b, strpos(out, '<M>') AS c FROM written)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN (q - p)::BIGINT END AS middle_chars, sha256(out) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN out
                  WHEN 'psm' THEN substring(out, a + 3, b - a - 3) || substring(out, c + 3) || substring(out, b + 3, c - b - 3)
                  ELSE substring(out, a + 3, c - a - 3) || substring(out, c + 3) || substring(out, b + 3, a - b - 3) END) AS restored_sha256
FROM marked
"""
