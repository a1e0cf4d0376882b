"""HTML pages to text blocks and block text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.markup import page_blocks
from pageloom.schemas import BLOCK


def _block_lists(pages: list, with_text: bool, least_own: int) -> tuple[pa.Array, pa.Array]:
    """Arrow columns ``blocks`` and ``html_error`` of a batch of pages."""
    offsets, pos, errors = [0], [], []
    columns: tuple[list, ...] = tuple([] for _ in range(7))
    for page in pages:
        rows, error = ([], None) if page is None else page_blocks(page, with_text, least_own)
        for number, row in enumerate(rows):
            pos.append(number)
            for column, value in zip(columns, row):
                column.append(value)
        offsets.append(len(pos))
        errors.append(error)
    names = ["pos", "tag", "text", "own_text", "src", "alt", "xpath", "in_nav"]
    kinds = [pa.int32(), *[pa.string()] * 6, pa.bool_()]
    arrays = [pa.array(v, k) for v, k in zip((pos, *columns), kinds)]
    blocks = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, names)
    )
    return blocks, pa.array(errors, pa.string())


def html_blocks(
    df: DataFrame, html: str = "html", with_text: bool = True, keep_html: bool = False, wanted: str | None = None, least_own: int = 0
) -> DataFrame:
    """Replace the ``html`` column by ``blocks ARRAY<STRUCT>`` and ``html_error``.

    One Python pass over Arrow batches, no shuffle, one row in and one out. The text of
    nested unclosed paragraphs repeats, so it can outgrow the page; ``with_text=False``
    leaves it NULL for callers that read ``own_text`` alone. ``keep_html`` keeps the page. Filter on the URL before this
    step, since no filter moves below it, or name a boolean column ``wanted``: rows where it is
    not true go through without blocks. ``least_own`` gives an XPath only to blocks of so many
    characters of own text, for rules that take no shorter ones.
    """
    others = [f for f in df.schema.fields if f.name != html]
    kept = [df.schema[html], *others] if keep_html else others
    names = [f.name for f in kept] + ["blocks", "html_error"]
    first = 0 if keep_html else 1

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few pages at a time, so that the repeated text stays small in memory.
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                pages = part.column(0).to_pylist()
                if wanted is not None:
                    flags = part.column(part.schema.get_field_index(wanted)).to_pylist()
                    pages = [page if flag else None for page, flag in zip(pages, flags, strict=True)]
                blocks, errors = _block_lists(pages, with_text, least_own)
                yield pa.RecordBatch.from_arrays([*part.columns[first:], blocks, errors], names)

    schema = T.StructType(
        [*kept, T.StructField("blocks", T.ArrayType(BLOCK)), T.StructField("html_error", T.StringType())]
    )
    return df.select(html, *[f.name for f in others]).mapInArrow(parse, schema)


def block_rows(df: DataFrame) -> DataFrame:
    """One row per block; pages without any are gone."""
    others = [c for c in df.columns if c not in ("blocks", "html_error")]
    return df.select(*others, F.inline("blocks"))


def rendered(block: Column) -> Column:
    image = F.concat(F.lit('<img src="'), block["src"], F.lit('" alt="'), block["alt"], F.lit('">'))
    tag = block["tag"]
    text = F.concat(F.lit("<"), tag, F.lit(">"), block["text"], F.lit("</"), tag, F.lit(">"))
    return F.when(tag == "img", image).otherwise(text)


def processed_html(blocks: Column) -> Column:
    """The block text of a page, one rendered block per line, from its ``blocks``."""
    return F.array_join(F.transform(blocks, rendered), "\n")
