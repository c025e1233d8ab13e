"""Tables and decisions of a form: defect blocks, analysis rows, the final decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.functions.geometry import pixels
from formloom.operators import anchors as A
from formloom.operators import layout as L

# Words that tell a block's kind, in the order of the checks, and the decisions.
BLOCK_KINDS = [("geometry", ["геометрия"]), ("holes", ["отверстия", "вал"]), ("surface", ["поверхность"])]
ACTIONS = ["использовать", "доработать", "не использовать"]

_DEFECT = ["row_number", "parameter", "fact_value", "deviation", "quantity"]
_SURFACE = ["row_number", "defect", "quantity"]
_ANALYSIS = ["row_number", "operation", "cause", "responsible", "decision"]


def classify(title: Column) -> Column:
    out = F.lit("other")
    for kind, words in reversed(BLOCK_KINDS):
        out = F.when(T.has_any(title, words), kind).otherwise(out)
    return out


def _by_x(row: Column) -> Column:
    return A.by_distance(row, lambda d: d.cx)


def _texts(row: Column) -> Column:
    return F.transform(row, lambda d: d.text)


def _average(row: Column) -> Column:
    return F.aggregate(row, F.lit(0.0), lambda a, d: a + d.confidence) / F.size(row)


def _at(row: Column, k: int) -> Column:
    return T.strip(F.get(row, F.lit(k)).text)


def _defect_row(row: Column, kind: Column) -> Column:
    """Fields by place: surface blocks have a defect and a quantity, others a parameter, its value, deviation and quantity."""
    surface = kind == "surface"
    place = lambda name: F.when(surface, _at(row, _SURFACE.index(name)) if name in _SURFACE else F.lit(None)).otherwise(
        _at(row, _DEFECT.index(name)) if name in _DEFECT else F.lit(None)
    )
    names = ["row_number", "parameter", "defect", "fact_value", "deviation", "quantity"]
    return F.struct(*(place(n).alias(n) for n in names), _average(row).alias("confidence"), _texts(row).alias("source_texts"))


def blocks_of(defects: Column, width: Column, height: Column) -> Column:
    """[(block, kind, title, headers, rows)] of a page's defects, see defect_blocks."""
    def block(members: Column, i: Column) -> Column:
        edge = F.array_min(F.transform(members, lambda d: d.cy)) + 50
        # members come in the order of x; a stable sort by y keeps that order among equals
        by_y = F.transform(F.array_sort(F.transform(members, lambda d, n: F.struct(d.cy.alias("cy"), n.alias("n"), d.alias("d")))), lambda x: x.d)
        parts = lambda e, ds: F.struct(
            F.array_join(_texts(F.filter(ds, lambda d: d.cy < e)), " ").alias("title"), L.rows(F.filter(ds, lambda d: d.cy >= e), pixels(0.6, height)).alias("lines")
        )
        return T.let(edge, lambda e: T.let(by_y, lambda ds: T.let(parts(e, ds), lambda p: whole(p, i))))

    def whole(p: Column, i: Column) -> Column:
        kind = classify(p.title)
        rows = F.transform(F.slice(p.lines, 2, F.size(p.lines)), lambda r: T.let(_by_x(r), lambda own: _defect_row(own, kind)))
        made = F.struct(i.alias("block"), kind.alias("kind"), p.title.alias("title"), _texts(A.first(p.lines)).alias("headers"), rows.alias("rows"))
        return F.when(F.size(p.lines) > 0, made)

    return F.filter(F.transform(L.blocks(defects, pixels(12.0, width)), block), lambda b: b.isNotNull())


def defect_blocks(pages: DataFrame) -> DataFrame:
    """One row for each block of defects with a table: (doc_id, block, kind, title, headers, rows).

    Blocks are told apart by gaps in x. What lies within 50 pixels of a block's top is its title; of the
    rows below, the first is the header. A block without rows below its title is left out, but keeps its number.
    """
    return pages.select("doc_id", F.explode(blocks_of(F.col("defects"), F.col("width"), F.col("height"))).alias("b")).select("doc_id", "b.*")


def defect_rows_of_cells(cells: DataFrame) -> DataFrame:
    """cells(doc_id, row_idx, col_idx, text, confidence) -> a row for each data row of the grid, fields by place.

    The first row is the header where there are two or more. All rows are one block of kind ``other``.
    """
    member = F.struct("col_idx", "text", "confidence")
    rows = cells.groupBy("doc_id", "row_idx").agg(F.array_sort(F.collect_list(member)).alias("r"))
    head = cells.groupBy("doc_id").agg(F.min("row_idx").alias("head"), F.max("row_idx").alias("last"))
    place = lambda k: T.strip(F.get(F.col("r"), F.lit(k)).text)
    return (
        rows.join(head, "doc_id").where("row_idx > head or head = last")
        .select("doc_id", F.lit("other").alias("kind"), "row_idx", *(place(k).alias(n) for k, n in enumerate(_DEFECT)), _average(F.col("r")).alias("confidence"))
    )


def name_cells(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """cells ⋈ columns(col_idx, field_name): rows of (doc_id, row_idx, fields), fields a map from names to (text, confidence).

    A column without a name is ``col_<n>``. columns is a template's table: some tens of rows.
    """
    named = cells.join(F.broadcast(columns.select("col_idx", "field_name")), "col_idx", "left")
    name = F.coalesce("field_name", F.concat(F.lit("col_"), F.col("col_idx")))
    entry = F.struct(name.alias("key"), F.struct("text", "confidence").alias("value"))
    return named.groupBy("doc_id", "row_idx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("col_idx", entry.alias("e"))))["e"]).alias("fields"))


def lines_of(analysis: Column, height: Column) -> Column:
    """[(line, row_number, ..., confidence)] of a page's analysis, see analysis_rows."""
    def line(members: Column, i: Column) -> Column:
        fields = lambda r: F.struct(i.alias("line"), *(_at(r, k).alias(n) for k, n in enumerate(_ANALYSIS)), _average(r).alias("confidence"))
        return F.when((i > 0) & (F.size(members) >= 2), T.let(_by_x(members), fields))

    return F.filter(F.transform(L.rows(analysis, pixels(0.6, height)), line), lambda x: x.isNotNull())


def analysis_rows(pages: DataFrame) -> DataFrame:
    """(doc_id, line, row_number, operation, cause, responsible, decision, confidence): rows of two texts or more after the first."""
    return pages.select("doc_id", F.explode(lines_of(F.col("analysis"), F.col("height"))).alias("r")).select("doc_id", "r.*")


def _decided(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for action in ACTIONS:  # the last that the text holds wins
        out = F.when(T.has(text, action), action).otherwise(out)
    return out


def decision_of(zone: Column) -> Column:
    """(action, quantity, manager_name, otk_representative) of a page's analysis, or null, see final_decision."""
    acts = F.filter(zone, lambda d: T.has_any(d.text, ACTIONS))
    numbers = F.filter(F.transform(acts, lambda d: T.first_integer(d.text)), lambda n: n.isNotNull())

    def name(*words: str) -> Column:
        def labelled(d: Column) -> Column:
            out = F.lit(True)
            for w in words:
                out = out & T.has(d.text, w)
            return out

        found = F.transform(F.filter(zone, labelled), lambda at: A.first(F.filter(A.near(zone, at, 50, 400, 50), lambda d: T.looks_signed(T.strip(d.text)))))
        return T.strip(F.try_element_at(F.filter(found, lambda d: d.isNotNull()), F.lit(-1)).text)

    action = _decided(F.try_element_at(acts, F.lit(-1)).text)
    made = F.struct(
        action.alias("action"), F.try_element_at(numbers, F.lit(-1)).try_cast("bigint").alias("quantity"), name("руководитель").alias("manager_name"),
        name("представитель", "отк").alias("otk_representative"),
    )
    return F.when(action.isNotNull(), made)


def final_decision(pages: DataFrame) -> DataFrame:
    """(doc_id, action, quantity, manager_name, otk_representative) of documents with an action.

    The last text with an action gives it; the last such text with digits gives the quantity. Names lie
    50 to 400 pixels right of their labels; the last label with one wins.
    """
    return pages.select("doc_id", decision_of(F.col("analysis")).alias("d")).where("d is not null").select("doc_id", "d.*")
