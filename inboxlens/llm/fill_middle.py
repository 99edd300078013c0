"""Fill-in-the-middle documents, cut over code points and assembled over UTF-8 bytes.

A text is cut twice, into prefix, middle and suffix, and its parts are written in another order
between sentinels.  Cuts are counted in lines or code points but made in bytes.  The two are
converted by a sparse exception index: only characters of several bytes are recorded, with their
place and the bytes they have beyond one; everything between two of them is plain arithmetic.  Pure
ASCII text has an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import fresh, short_batches

#: Sentinels in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percent of the texts that are cut, and percent of those with the suffix in front.
RATE, SPM_RATE = 100, 50
LINES, CHARACTERS = "lines", "characters"
_NEWLINE = 10


class Exceptions:
    """Where the characters of several bytes lie in UTF-8 bytes, and how many bytes they add.

    ``starts`` are byte positions of such characters, ``added[k]`` the excess bytes of the first
    ``k`` of them, and ``chars`` their code-point positions.
    """

    def __init__(self, data: np.ndarray) -> None:
        self.starts = np.flatnonzero(data >= 0xC0)
        lead = data[self.starts]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.added = np.concatenate([[0], np.cumsum(excess)])
        self.chars = self.starts - self.added[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points in front of byte positions that lie between characters."""
        return cuts - self.added[np.searchsorted(self.starts, cuts, "left")]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte positions in front of which there are so many code points."""
        return cuts + self.added[np.searchsorted(self.chars, cuts, "left")]


def _cuts(data, begin, end, index: Exceptions, unit: str, draws):
    """Units of every text and the byte positions after the drawn numbers of them.

    ``begin`` and ``end`` are the texts' byte positions in ``data``.
    """
    if unit == CHARACTERS:
        first = index.to_chars(begin)
        n = index.to_chars(end) - first
        return n, [index.to_bytes(first + draw % (n + 1)) for draw in draws]
    newlines = np.flatnonzero(data == _NEWLINE)
    first = np.searchsorted(newlines, begin, "left")
    lines = np.searchsorted(newlines, end, "left") - first
    # what follows the last newline is a line too, where there is anything
    open_end = (end > begin) & (data[np.maximum(end, 1) - 1] != _NEWLINE if len(data) else False)
    n = lines + open_end
    after = np.concatenate([newlines + 1, [0]])
    places = []
    for draw in draws:
        units = draw % (n + 1)
        inner = after[np.minimum(first + np.maximum(units, 1) - 1, len(newlines))]
        places.append(np.where(units == 0, begin, np.where(units == n, end, inner)))
    return n, places


def _rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a column of texts, and where each text begins and ends in them."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[: at[-1]], at[:-1], at[1:]


def _cut_batches(unit: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text, form, h1, h2, *kept = batch.columns
            data, begin, end = _rows(text)
            index = Exceptions(data)
            draws = [h.to_numpy(zero_copy_only=False) for h in (h1, h2)]
            n, places = _cuts(data, begin, end, index, unit, draws)
            low, high = np.minimum(*places), np.maximum(*places)
            forms = form.to_pylist()
            plain = np.array([f == "plain" for f in forms])
            chars = [index.to_chars(p) for p in (begin, low, high)]
            view = memoryview(data)
            out = []
            for f, a, b, c, d in zip(forms, begin, low, high, end, strict=True):
                if f == "plain":
                    out.append(bytes(view[a:d]))
                    continue
                prefix, middle, suffix = view[a:b], view[b:c], view[c:d]
                parts = [(PREFIX, prefix), (SUFFIX, suffix)]
                ordered = parts[::-1] if f == "spm" else parts
                out.append(b"".join(x for s, t in [*ordered, (MIDDLE, middle)] for x in (s.encode(), t)))
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(n, pa.int64()),
                    form,
                    pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
                    pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
                    pa.array(out, pa.binary()).view(pa.string()),
                ],
                names=names,
            )

    return run


def _drawn(sha: Column, group: int) -> Column:
    """The 8-digit group of a hex digest as an unsigned integer."""
    return F.conv(F.substring(sha, 8 * group + 1, 8), 16, 10).cast("bigint")


def transform(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    unit: str = LINES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row's kept columns (all by default) with ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``n`` counts the units of the text: lines with their newline, or code points.  The cuts follow
    from the first two 32-bit numbers of sha256 of ``seed:id``, the form from the next two, so a
    row is cut alike wherever it is processed.  A form is ``psm``, ``spm``, or ``plain``: an empty
    text, one that holds a sentinel, and the share that ``rate`` leaves out stay as they are, with
    null lengths.  A null text counts as empty and a null id as an empty one; rows that repeat an id
    are cut by their own text at the same numbers.  Whole texts are read, however long; other
    columns are only handed on, and a clashing name gets underscores in front.  An empty table gives
    an empty result.
    """
    if unit not in (LINES, CHARACTERS):
        raise ValueError(f"unit {unit!r}")
    kept = [id_col, *(c for c in (keep or docs.columns) if c != id_col)]
    names = [fresh(docs, c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")]
    short_batches(docs.sparkSession, 256)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sha = F.sha2(key, 256)
    held = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(text, F.lit(sentinel))
    form = (
        F.when((text == "") | held | (_drawn(sha, 2) % 100 >= rate), "plain")
        .when(_drawn(sha, 3) % 100 < spm_rate, "spm")
        .otherwise("psm")
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    n, form_name, prefix, middle, output = names
    schema = (
        f"{kinds}, `{n}` bigint, `{form_name}` string, `{prefix}` bigint, `{middle}` bigint, "
        f"`{output}` string"
    )
    own = [
        c.alias(fresh(docs, f"drawn_{k}"))
        for k, c in enumerate((text, form, _drawn(sha, 0), _drawn(sha, 1)))
    ]
    return docs.select(*own, *kept).mapInArrow(_cut_batches(unit, [*kept, *names]), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, read from the output and its form alone.

    Parts hold no sentinel, and none can arise where a part meets one, so the three sentinels
    are the only ones.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )


QUERY = "op13_fill_middle"
SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbered AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM drawn
), cut AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
      THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(list_slice(u, 1, a), '') AS p,
    array_to_string(list_slice(u, a + 1, b), '') AS m,
    array_to_string(list_slice(u, b + 1, n), '') AS s
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every whole text of ``documents``, cut at lines."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = transform(docs, keep=["doc_id"])
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
