"""Fields of a form's header, as expressions over the array of its detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.functions.geometry import percent, pixels
from formloom.operators import anchors as A

# Words by which fields are found.
STICKER_WORDS = ["строка:", "кол-во:", "количество:", "план", "дата:", "заказа", "клиент"]
CONTROL_TYPES = ["операционный", "входной", "выходной"]
MARKS = ["✓", "☑", "☐", "v", "x", "х"]
INSPECTOR_WORDS = ["контролер", "контролёр", "отк", "фио"]
MANDATORY = ["act_date", "act_number", "control_type", "inspector_name", "part_line_number", "quantity_checked", "template_revision"]


def _mean(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, d: a + d.confidence) / F.size(array)


def act_number(header: Column, width: Column, height: Column) -> Column:
    """The first text below ``Номер`` that begins with digits: those digits."""
    under = A.below(header, A.anchor(header, "Номер"), height, pixels(2.9, height), pixels(2.0, width))
    found = A.first(F.filter(under, lambda d: T.matches(T.strip(d.text), r"^\d+")))
    return T.let(found, lambda d: A.field(T.group(T.strip(d.text), r"^(\d+)"), d.confidence, "header"))


def act_date(header: Column, width: Column, height: Column) -> Column:
    """Numbers on the line of ``Дата``, between ``Номер`` and ``Рев``, from left to right."""
    def parts(x: Column) -> Column:
        def inside(d: Column) -> Column:
            other = lambda a: F.coalesce(~A.same(d, a), F.lit(True))
            zone = (F.abs(d.cy - x.date.cy) < pixels(2.0, height)) & (d.cx > F.coalesce(x.number.cx, F.lit(0))) & (d.cx < F.coalesce(x.revision.cx, width))
            return T.matches(d.text, r"\d") & zone & other(x.number) & other(x.date) & other(x.revision)

        return F.when(x.date.isNotNull(), A.by_distance(F.filter(header, inside), lambda d: d.cx))

    at = F.struct(A.anchor(header, "Номер").alias("number"), A.anchor(header, "Дата").alias("date"), A.anchor(header, "Рев").alias("revision"))
    numbers = lambda p: F.flatten(F.transform(p, lambda d: T.integers(d.text)))
    return T.let(T.let(at, parts), lambda p: T.let(T.date_of_parts(numbers(p)), lambda v: A.field(v, _mean(p), "header")))


def template_revision(header: Column, width: Column, height: Column) -> Column:
    """The first text below ``Рев`` with a capital and digits."""
    pattern = r"([A-ZА-Я])\s*(\d+)"
    under = A.below(header, A.anchor(header, "Рев"), height, pixels(2.9, height), pixels(2.0, width))
    found = A.first(F.filter(under, lambda d: T.matches(d.text, pattern)))
    return T.let(found, lambda d: A.field(F.concat(T.group(T.strip(d.text), pattern, 1), T.group(T.strip(d.text), pattern, 2)), d.confidence, "header"))


def quantity(header: Column, width: Column, height: Column, status: str) -> Column:
    """The nearest whole number to the right of a status word, in the column of ``КОЛ-ВО`` where there is one."""
    def best(column: Column) -> Column:
        aligned = lambda d: F.coalesce(column.isNull() | (F.abs(d.cx - column.cx) < pixels(4.0, width)), F.lit(True))
        right = lambda at: A.right_of(header, at, pixels(12.0, width), pixels(1.5, height))
        return A.first(F.flatten(F.transform(A.anchors(header, [status]), lambda at: F.filter(right(at), lambda d: T.matches(T.strip(d.text), r"^\d+$") & aligned(d)))))

    return T.let(T.let(A.anchor(header, "КОЛ-ВО"), best), lambda d: A.field(T.strip(d.text), d.confidence, "header"))


def _control(d: Column) -> Column:
    out = F.lit(None).cast("string")
    for name in reversed(CONTROL_TYPES):
        out = F.when(T.has(d.text, name), name).otherwise(out)
    return out


def control_type(header: Column) -> Column:
    """In order: a mark's first type word within 50 pixels of its height, or a type word itself."""
    def candidates(d: Column) -> Column:
        beside = F.filter(header, lambda o: (F.abs(o.cy - d.cy) < 50) & T.has_any(o.text, CONTROL_TYPES))
        marked = F.when(T.has_any(d.text, MARKS), beside).otherwise(F.array().cast(f"array<{A.DETECTION}>"))
        own = F.when(T.has_any(d.text, CONTROL_TYPES), F.array(d)).otherwise(F.array().cast(f"array<{A.DETECTION}>"))
        return F.concat(marked, own)

    found = A.first(F.flatten(F.transform(header, candidates)))
    return T.let(found, lambda d: A.field(F.when(d.isNotNull(), _control(d)), d.confidence, "header"))


def inspector(header: Column, width: Column, height: Column) -> Column:
    """The best name below or to the right of the inspector's label; capitals weigh 1.1, so a confidence may exceed 1."""
    around = F.flatten(F.transform(A.anchors(header, INSPECTOR_WORDS), lambda at: A.below_or_right(header, at, width, height)))
    scored = lambda array, weight: F.transform(array, lambda d, n: F.struct((-(d.confidence * weight(d))).alias("least"), n.alias("n"), T.strip(d.text).alias("text")))
    def best(near: Column) -> Column:
        names = F.filter(near, lambda d: (d.confidence >= 0.4) & T.looks_like_name(T.strip(d.text)))
        letters = F.filter(near, lambda d: (d.confidence >= 0.3) & (F.char_length(T.strip(d.text)) >= 2) & F.exists(T.words(d.text), lambda w: w.rlike(r"^\p{L}+$")))
        strong = F.array_min(scored(names, lambda d: F.when(T.capitalised(d.text), 1.1).otherwise(1.0)))
        return F.coalesce(strong, F.array_min(scored(letters, lambda d: F.lit(0.9))))

    return T.let(T.let(around, best), lambda b: A.field(b.text, -b.least, "header"))


def part_line(header: Column) -> Column:
    """Digits in the text of ``строка``, or a whole number right of it."""
    def value(at: Column) -> Column:
        beside = A.first(F.filter(A.near(header, at, 20, 200, 30), lambda d: T.matches(T.strip(d.text), r"^\d+$")))
        own = A.field(T.first_integer(at.text), at.confidence, "header")
        return F.coalesce(own, T.let(beside, lambda d: A.field(T.strip(d.text), d.confidence, "header")))

    return A.first(F.filter(F.transform(A.anchors(header, ["строка"]), value), lambda f: f.isNotNull()))


def labelled(header: Column, words: list[str], longer_than: int) -> Column:
    """The first text right of a label, if it is longer than a number of characters; else that of the next label."""
    def value(at: Column) -> Column:
        found = A.first(A.near(header, at, 20, 400, 30))
        return T.let(found, lambda d: F.when(F.char_length(T.strip(d.text)) > longer_than, A.field(T.strip(d.text), d.confidence, "header")))

    return A.first(F.filter(F.transform(A.anchors(header, words), value), lambda f: f.isNotNull()))


def sticker(header: Column, width: Column, height: Column) -> Column:
    """The sticker's fields, from a tight group of two of its words or more; null without a part line. The last match of a field wins."""
    def fields(group: Column) -> Column:
        extent = lambda k: F.array_max(F.transform(group, lambda d: d[k])) - F.array_min(F.transform(group, lambda d: d[k]))
        tight = (F.size(group) >= 2) & (extent("cx") <= pixels(16.0, width)) & (extent("cy") <= pixels(8.5, height))

        def last(words: list[str], value) -> Column:
            made = F.transform(A.anchors(group, words), lambda d: A.field(value(d.text), d.confidence, "sticker"))
            return F.try_element_at(F.filter(made, lambda f: f.isNotNull()), F.lit(-1))

        day = r"(\d{1,2})[.\s](\d{1,2})[.\s](\d{4})"
        made = F.struct(
            last(["строка"], lambda t: T.group(F.lower(t), r"строка[:\s]*(\d+)")).alias("part_line_number"),
            last(["кол-во", "количество"], T.first_integer).alias("quantity_ordered"),
            last(["заказа"], T.first_integer).alias("order_number"),
            last(["дата"], lambda t: F.when(T.matches(t, day), F.concat_ws(".", *(T.group(t, day, i) for i in (1, 2, 3))))).alias("order_date"),
            last(["клиент"], lambda t: T.strip(T.group(F.lower(t), r"клиент[:\s]+(.+)"))).alias("client"),
        )
        return T.let(made, lambda m: F.when(tight & m.part_line_number.isNotNull(), m))

    return T.let(A.anchors(header, STICKER_WORDS), fields)


def _corner(header: Column, width: Column, height: Column) -> Column:
    """Detections in the top right corner, where the form has its number and date."""
    return F.filter(header, lambda d: percent(d.cx, width).between(70.0, 100.0) & percent(d.cy, height).between(0.0, 8.0))


def _cells_below(header: Column, width: Column, height: Column, keyword: str) -> Column:
    under = lambda corner: A.below(corner, A.anchor(corner, keyword), height, pixels(2.9, height), pixels(2.0, width))
    return F.filter(T.let(_corner(header, width, height), under), lambda d: (d.confidence >= 0.4) & T.matches(d.text, r"\d"))


def form_number(header: Column, width: Column, height: Column, slashes: bool = True, digits: bool = True) -> Column:
    """The number below ``номер`` in the corner, joined of its cells and repaired, as ddd/dd."""
    line = lambda cells: F.filter(cells, lambda d: F.abs(d.cy - A.first(cells).cy) <= pixels(5.0, height))

    def made(own: Column) -> Column:
        joined = F.array_join(F.transform(own, lambda d: T.strip(d.text)), "")
        number = T.let(T.let(joined, T.insert_slash), lambda t: T.blank_number(t, slashes, digits))
        return F.when(F.size(own) > 0, T.let(number, lambda n: A.field(n.value, _mean(own), "header", n.corrected)))

    return T.let(T.let(_cells_below(header, width, height, "номер"), line), made)


def form_date(header: Column, width: Column, height: Column, slashes: bool = True, digits: bool = True) -> Column:
    """The date below ``дата`` in the corner, from left to right. corrected only tells that repairs are on."""
    ordered = A.by_distance(_cells_below(header, width, height, "дата"), lambda d: d.cx)
    numbers = F.flatten(F.transform(ordered, lambda d: F.transform(T.integers(d.text), lambda n: F.struct(n.alias("n"), d.confidence.alias("confidence")))))
    dated = lambda ns: T.let(T.date_of_cells(F.transform(ns, lambda x: x.n)), lambda v: A.field(v, _mean(ns), "header", F.lit(slashes or digits)))
    return T.let(numbers, dated)


def extract_header(pages: DataFrame, specialised: bool = True, slashes: bool = True, digits: bool = True) -> DataFrame:
    """Adds a column for each header field and the sticker's to pages(width, height, header).

    The specialised number and date, where asked for, go before the plain ones; the part's fields are
    looked for only where there is no sticker.
    """
    h, w, t = F.col("header"), F.col("width"), F.col("height")
    out = pages.withColumn("sticker", sticker(h, w, t))
    number, date = act_number(h, w, t), act_date(h, w, t)
    if specialised:
        number, date = F.coalesce(form_number(h, w, t, slashes, digits), number), F.coalesce(form_date(h, w, t, slashes, digits), date)
    alone = lambda f: F.when(F.col("sticker").isNull(), f)
    return out.withColumns(
        {
            "act_number": number,
            "act_date": date,
            "template_revision": template_revision(h, w, t),
            "quantity_checked": quantity(h, w, t, "ПРОВЕРЕНО"),
            "quantity_passed": quantity(h, w, t, "ГОДНО"),
            "quantity_defective": quantity(h, w, t, "С ДЕФЕКТАМИ"),
            "control_type": control_type(h),
            "inspector_name": inspector(h, w, t),
            "part_line_number": F.coalesce(F.col("sticker.part_line_number"), alone(part_line(h))),
            "quantity_ordered": F.col("sticker.quantity_ordered"),
            "part_designation": alone(labelled(h, ["обозначение", "изделие"], 2)),
            "part_name": alone(labelled(h, ["наименование"], 1)),
        }
    )
