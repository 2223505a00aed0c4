"""Fill-in-the-middle by displacement scatter (operator 12).

A text is cut into units ``[A-Za-z]+|[^A-Za-z]`` (code points). Four numbers
from the SHA-256 of ``seed:id`` choose two cuts between units and the form:
``plain`` (the text as it is), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>``
middle) or ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>`` middle).

Work is done on the bytes of many texts at once. A scan marks the unit starts
and so the cuts; every piece of every text has a displacement, the distance
from its place in the input to its place in the output. A difference array
holds the change of displacement where a piece starts, its cumulative sum is
the shift of every byte, and one numpy scatter writes the whole output. The
inverse reads only outputs and forms: it finds the marks, sums the difference
array of the inverse displacements and gathers the texts back.

Defined results: null and empty texts give the empty plain output with no
units. A null id counts as the empty string. A text that contains a mark is
plain, so the marks of an output are never ambiguous. Repeated rows with equal
ids are cut alike; equal numbers (ties of the two cuts) give an empty middle.
Very long texts are cut whole, one at a time; others are taken together up to
``SLICE`` bytes. An empty table gives an empty result. A column of the input
named like the output keeps its values: the new one gets an underscore.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import fresh, table

#: Bytes of text that are displaced together.
SLICE = 1 << 18
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
#: Order of the pieces in an output; the numbers are P, S and M as below.
ORDERS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
LETTERS = b"PSM"


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array (null: empty) and their bounds."""
    flat = pc.fill_null(texts, "").cast(pa.large_binary())
    _, bounds, data = flat.buffers()
    at = np.frombuffer(bounds, np.int64, len(flat) + 1, 8 * flat.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def texts_from(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def slices(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` bytes; a longer text is one by itself."""
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE, "right")) - 1)
        yield i, j
        i = j


def find_marks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each mark and the row it lies in."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = (data[:-2] == 60) & (data[2:] == 62)
    place = np.flatnonzero(hit)
    place = place[np.isin(data[place + 1], np.frombuffer(LETTERS, np.uint8))]
    row = np.searchsorted(at, place, "right") - 1
    inside = place + 3 <= at[row + 1]
    return place[inside], row[inside]


def shifts(starts: np.ndarray, moves: np.ndarray, size: int) -> np.ndarray:
    """Shift of each of ``size`` bytes from the pieces' starts (ascending) and
    displacements: a difference array, summed up."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(moves, prepend=0))
    return np.cumsum(change[:size], out=change[:size])


def layout(form: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pieces and marks (P, S, M; rows by 3) in each output."""
    pieces, marks = np.zeros_like(sizes), np.zeros_like(sizes)
    for k, name in enumerate(ORDERS, 1):
        rows, used = form == k, 0
        for piece in ORDERS[name]:
            marks[rows, piece] = used
            pieces[rows, piece] = used + 3
            used = used + 3 + sizes[rows, piece]
    return pieces, marks


def transform(data: np.ndarray, at: np.ndarray, draws: np.ndarray, plain_from: int, spm_below: int) -> dict:
    """Cuts, forms and outputs of the texts of one slice. ``draws``: four
    numbers a row."""
    rows, starts = len(at) - 1, at[:-1]
    letter = ((data | 32) - np.uint8(97)) < 26
    point = (data & 0xC0) != 0x80
    unit = point.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    unit[starts[starts < at[1:]]] = True
    where = np.flatnonzero(unit)
    first = np.searchsorted(where, at)
    n = np.diff(first)
    where = np.append(where, len(data))
    both = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    ends = [np.where(both[:, k] < n, where[np.minimum(first[:-1] + both[:, k], len(where) - 1)], at[1:]) for k in (0, 1)]
    marked = np.zeros(rows, bool)
    marked[find_marks(data, at)[1]] = True
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= plain_from)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm_below, 2, 1))

    # pieces in the order of the input: prefix, middle, suffix
    cut = np.stack([starts, np.where(plain, at[1:], ends[0]), np.where(plain, at[1:], ends[1]), at[1:]], axis=1)
    sizes = np.diff(cut, axis=1)[:, [0, 2, 1]]  # P, S, M
    places, marks = layout(form, sizes)
    out_at = np.append(0, np.cumsum(np.diff(at) + 9 * ~plain))
    moves = (out_at[:-1, None] + places)[:, [0, 2, 1]] - cut[:, :3]
    out = np.empty(out_at[-1], np.uint8)
    to = shifts(cut[:, :3].ravel(), moves.ravel(), len(data))
    to += np.arange(len(data))
    out[to] = data
    put = (out_at[:-1, None] + marks)[~plain]
    for k, mark in enumerate(MARKS.values()):
        out[put[:, k, None] + np.arange(3)] = np.frombuffer(mark, np.uint8)
    points = np.append(0, np.cumsum(point))
    chars = np.diff(points[cut], axis=1)
    return {"n": n, "form": form, "prefix_chars": chars[:, 0], "middle_chars": chars[:, 1], "out": out, "at": out_at}


def restore(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of one slice from their outputs and forms alone."""
    place, row = find_marks(data, at)
    place, row = place[form[row] > 0], row[form[row] > 0]
    moved = np.flatnonzero(form > 0)
    if not (len(row) == 3 * len(moved) and (row.reshape(-1, 3) == moved[:, None]).all()):
        raise ValueError("an output without exactly three marks")
    ends = np.concatenate([place.reshape(-1, 3)[:, 1:], at[moved + 1, None]], axis=1)
    kind = np.searchsorted(np.sort(np.frombuffer(LETTERS, np.uint8)), data[place + 1]).reshape(-1, 3)
    kind = np.array([2, 0, 1])[kind]  # letters in alphabetical order: M, P, S
    begin, size = np.tile(at[:-1, None], 3), np.zeros((len(form), 3), np.int64)
    size[:, 0] = np.diff(at)
    size[moved] = np.take_along_axis(ends - place.reshape(-1, 3) - 3, np.argsort(kind, axis=1), axis=1)
    begin[moved] = np.take_along_axis(place.reshape(-1, 3) + 3, np.argsort(kind, axis=1), axis=1)
    text_at = np.append(0, np.cumsum(size.sum(1)))
    starts = text_at[:-1, None] + np.stack([0 * size[:, 0], size[:, 0] + size[:, 2], size[:, 0]], axis=1)  # P, S, M
    order = [0, 2, 1]
    back = shifts(starts[:, order].ravel(), (begin - starts)[:, order].ravel(), int(text_at[-1]))
    back += np.arange(len(back))
    return data[back], text_at


FORMS = np.array(["plain", *ORDERS])


_STRUCT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                     ("text", pa.string())])


def _struct(done: dict) -> pa.Array:
    plain = done["form"] == 0
    return pa.StructArray.from_arrays([
        pa.array(done["n"], pa.int64()), pa.array(FORMS[done["form"]], pa.string()),
        *[pa.array(done[k], pa.int64(), mask=plain) for k in ("prefix_chars", "middle_chars")],
        texts_from(done["out"], done["at"])], fields=list(_STRUCT))


def transform_batch(ids: pa.Array, texts: pa.Array, seed: int, plain_from: int, spm_below: int) -> pa.Array:
    data, at = bytes_of(texts)
    keys = (hashlib.sha256(f"{seed}:{i or ''}".encode()).digest()[:16] for i in ids.to_pylist())
    draws = np.frombuffer(b"".join(keys), ">u4").reshape(-1, 4).astype(np.int64)
    parts = [_struct(transform(data[at[i] : at[j]], at[i : j + 1] - at[i], draws[i:j], plain_from, spm_below))
             for i, j in slices(at)]
    return pa.concat_arrays(parts) if parts else pa.array([], _STRUCT)


def restore_batch(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    data, at = bytes_of(outputs)
    known = {name: k for k, name in enumerate(FORMS)}
    code = np.array([known[f or "plain"] for f in forms.to_pylist()], np.int64)
    parts = [texts_from(*restore(data[at[i] : at[j]], at[i : j + 1] - at[i], code[i:j])) for i, j in slices(at)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "fim", seed: int = 1,
                   plain_from: int = 90, spm_below: int = 20, restore: bool = False) -> DataFrame:
    """``df`` with a struct column ``out``: units ``n``, ``form``, the lengths
    ``prefix_chars`` and ``middle_chars`` (null if plain) and the new ``text``.
    Of a hundred draws those from ``plain_from`` on are plain; of the others
    those below ``spm_below`` in a hundred have the suffix first. With
    ``restore`` a further field ``restored`` holds the text gathered back from
    ``text`` and ``form`` by the same worker, as :func:`restored` does."""
    (o,) = fresh(df, out)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            made = transform_batch(ids, texts, seed, plain_from, spm_below)
            if restore:
                back = restore_batch(made.field("text"), made.field("form"))
                made = pa.StructArray.from_arrays([*made.flatten(), back], fields=[*_STRUCT, pa.field("restored", pa.string())])
            yield made

    kind = "n bigint, form string, prefix_chars bigint, middle_chars bigint, text string" + ", restored string" * restore
    return df.withColumn(o, F.arrow_udf(run, kind)(F.col(id_col).cast("string"), F.col(text_col)))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from (null form: plain)."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            yield restore_batch(outputs, forms)

    return F.arrow_udf(run, "string")(output, form)


def op12_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(docs, restore=True).select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.text", 256).alias("output_sha256"), F.sha2("fim.restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), n AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""
