"""Pages to element trees: one row per page, the tree as arrays beside it.

Keeping a page's elements in its own row makes every per-page rule a column expression:
learning templates and applying them never shuffles page content.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.pages import tree
from millrace.pages.tree import NODE_FIELDS, parse_page

# The parser travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(tree)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES_PER_BATCH = 128

NODE = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("cut", T.BooleanType()),
        T.StructField("own", T.StringType()),
        T.StructField("text_len", T.IntegerType()),
        T.StructField("first_piece", T.IntegerType()),
        T.StructField("n_pieces", T.IntegerType()),
    ]
)
PIECE = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("cut", T.BooleanType()),
        T.StructField("text", T.StringType()),
    ]
)
assert tuple(NODE.names) == NODE_FIELDS


def _nested(rows_per_page: list[list], struct: pa.StructType) -> pa.ListArray:
    offsets = [0]
    flat: list = []
    for rows in rows_per_page:
        flat.extend(rows)
        offsets.append(len(flat))
    columns = list(zip(*flat)) if flat else [()] * struct.num_fields
    fields = [pa.array(c, type=f.type) for c, f in zip(columns, struct)]
    values = pa.StructArray.from_arrays(fields, fields=list(struct))
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), values, type=pa.list_(pa.field("element", struct))
    )


def with_tree(
    pages: DataFrame, html: str = "html", keep_html: bool = False, wanted: Column | None = None
) -> DataFrame:
    """Add `nodes` and `pieces` parsed from `html`; other columns pass through.

    Rows that are not `wanted` get the empty tree of a page without html.
    """
    mark, marked = "__wanted", wanted is not None
    if marked:
        pages = pages.withColumn(mark, F.coalesce(wanted, F.lit(False)))
    kept = [f for f in pages.schema.fields if (keep_html or f.name != html) and f.name != mark]
    names = [f.name for f in kept]
    schema = T.StructType(
        [*kept, T.StructField("nodes", T.ArrayType(NODE)), T.StructField("pieces", T.ArrayType(PIECE))]
    )
    node_type = to_arrow_schema(NODE)
    piece_type = to_arrow_schema(PIECE)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node_struct, piece_struct = pa.struct(list(node_type)), pa.struct(list(piece_type))
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(at, PAGES_PER_BATCH)
                # Bytes that are not UTF-8 become replacement characters, as in the JVM.
                texts = part.column(html).cast(pa.binary()).to_pylist()
                if marked:
                    flags = part.column(mark).to_pylist()
                    texts = [t if flag else None for t, flag in zip(texts, flags)]
                parsed = [parse_page(t and t.decode("utf-8", "replace")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        _nested([p[0] for p in parsed], node_struct),
                        _nested([p[1] for p in parsed], piece_struct),
                    ],
                    names=[*names, "nodes", "pieces"],
                )

    return pages.mapInArrow(parse, schema)


def elements(trees: DataFrame, keys: list[str]) -> DataFrame:
    """One row per element."""
    return trees.select(*keys, F.explode("nodes").alias("n")).select(
        *keys, "n.node", "n.parent", "n.last", "n.depth", "n.tag", "n.id", "n.cls", "n.cut",
        F.col("n.own").alias("own_text"), "n.text_len",
    )


def built_once(build: Callable[[], Column]) -> Callable[[], Column]:
    """Keep a large column expression per application instead of rebuilding it per batch."""
    kept: dict[str, Column] = {}

    @functools.wraps(build)
    def get() -> Column:
        application = SparkContext.getOrCreate().applicationId
        if application not in kept:
            kept.clear()
            kept[application] = build()
        return kept[application]

    return get


def let(value: Column, body) -> Column:
    """Bind a value once per row; a plain column alias may be re-evaluated inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def node_at(nodes: Column, index: Column) -> Column:
    return F.get(nodes, index)


def index_range(start: Column, count: Column) -> Column:
    """The whole numbers start .. start + count - 1.

    Parts of a page's arrays are read through such indexes: `get` is a direct access, while
    `slice` would copy the whole array each time.
    """
    return F.when(count > 0, F.sequence(start, start + count - 1)).otherwise(
        F.array().cast("array<int>")
    )


def live_children(nodes: Column, n: Column) -> Column:
    """Children outside cut subtrees; the subtree of n lies right behind it."""
    inside = index_range(n["node"] + 1, n["last"] - n["node"])
    own = F.filter(
        inside,
        lambda i: (F.get(nodes, i)["parent"] == n["node"]) & ~F.get(nodes, i)["cut"],
    )
    return F.transform(own, lambda i: F.get(nodes, i))


def text_of(pieces: Column, n: Column, keep: Callable[[Column], Column]) -> Column:
    """Kept pieces of an element put together, runs of spaces collapsed, both ends trimmed."""
    kept = F.filter(
        index_range(n["first_piece"] - 1, n["n_pieces"]), lambda i: keep(F.get(pieces, i))
    )
    whole = F.array_join(F.transform(kept, lambda i: F.get(pieces, i)["text"]), "")
    return F.trim(F.regexp_replace(whole, r"[ \t\n\f\r]+", " "))


def live_text(pieces: Column, n: Column) -> Column:
    """Text of an element without its cut subtrees."""
    return text_of(pieces, n, lambda p: ~p["cut"])
