"""Tables and links out of stored pages."""

import html as entities
import re
import sys
from functools import reduce

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F, types as T

CELLS = T.ArrayType(T.StringType())
TABLE_FIELDS = [
    T.StructField("table_idx", T.IntegerType()),
    T.StructField("is_header", T.BooleanType()),
    T.StructField("row_idx", T.IntegerType()),
    T.StructField("n_rows", T.IntegerType()),
    T.StructField("cells", CELLS),
]

# A row of plain cells is one token, as most rows are, and so are comments and whole scripts and
# styles; everything else is a tag or text.
_TOKEN = re.compile(
    r"<tr>(?P<row>(?:\s*+<t(?:d>[^<]*+</td>|h>[^<]*+</th>))++)\s*+</tr>"
    r"|<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|\Z)"
    # Quotes count only after an equals sign.
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S | re.I)
_PLAIN_CELL = re.compile(r"<(t[dh])>([^<]*)<", re.I)
_UNCLEAN = re.compile(r"&|[\r\n]|\s\s|>\s|\s<")
_SPAN = re.compile(r"\b(colspan|rowspan)\s*=\s*[\"']?\s*(\d+)", re.I)
_HIDDEN = re.compile(r"\bstyle\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none", re.I)
_VOID = {"br", "hr", "img", "input", "link", "meta", "wbr", "col", "area", "base", "embed", "source"}
# Elements whose end tag may be left out. Per element: where its like may be nested, and the start and end
# tags that close it. `_IN_TABLE` closes whatever a cell holds.
_IN_TABLE = {"td", "th", "tr", "tbody", "thead", "tfoot"}
_SECTIONS = {"tbody", "thead", "tfoot"}
_BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
           "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
_OPTIONAL_END = {
    "td": ({"table"}, _IN_TABLE, {"tr", "table", *_SECTIONS}), "th": ({"table"}, _IN_TABLE, {"tr", "table", *_SECTIONS}),
    "tr": ({"table"}, {"tr", *_SECTIONS}, {"table", *_SECTIONS}),
    **{tag: ({"table"}, _SECTIONS, {"table"}) for tag in _SECTIONS},
    "li": ({"ul", "ol"}, {"li"}, {"ul", "ol"}), "dt": ({"dl"}, {"dt", "dd"}, {"dl"}), "dd": ({"dl"}, {"dt", "dd"}, {"dl"}),
    "option": ({"select"}, {"option", "optgroup"}, {"select"}),
    "p": (set(), _BLOCKS | {"li", "dt", "dd"}, _BLOCKS | {"li", "dt", "dd", "body"}),
}
# A single space, of whatever kind, stays as it is; longer white space and line ends become one space.
_LONG_SPACE = re.compile(r"[\r\n]+|\s{2,}")


def _clean(text):
    if "&" in text:
        text = entities.unescape(text)
    return _LONG_SPACE.sub(" ", text.strip()) or None


class _Hidden:
    """An element that is not shown, up to its end tag or to the tag that implies its end."""

    def __init__(self, tag, in_table):
        self.tag, self.in_table, self.inside = tag, in_table, {}
        self.nests_in, self.starts, self.ends = _OPTIONAL_END.get(tag, ({tag}, set(), set()))

    def _nested(self):
        return any(self.inside.get(t) for t in self.nests_in)

    def meets(self, tag, ends):
        """What a tag does: "in" the element, the "end" of it, or "after" it (closes it and counts itself)."""
        # The parts of a table close what its cells hold, unless they belong to a table inside.
        cell_ends = self.in_table and self.tag not in _IN_TABLE and not self.inside.get("table") and (tag in _IN_TABLE or ends and tag == "table")
        if cell_ends:
            return "after"
        if not ends:
            if tag in self.starts and not self._nested():
                return "after"
            if tag not in _VOID:
                self.inside[tag] = self.inside.get(tag, 0) + 1
            return "in"
        if tag == self.tag and (tag in _OPTIONAL_END and not self._nested() or not self.inside.get(tag)):
            return "end"
        if self.inside.get(tag):
            self.inside[tag] -= 1
            return "in"
        return "after" if tag in self.ends else "in"


class _Table:
    """Rows of one table by section; a cell is [text pieces, tag, colspan, rowspan]."""

    def __init__(self):
        self.sections = {"thead": [], "tbody": [], "tfoot": []}
        self.section, self.row, self.cell = "tbody", None, None

    def end_cell(self):
        if self.cell is not None:
            self.cell[0] = _clean("".join(self.cell[0]))
            self.cell = None

    def end_row(self):
        self.end_cell()
        if self.row:
            self.sections[self.section].append(self.row)
        self.row = None

    def start_cell(self, tag, attrs):
        self.end_cell()
        if self.row is None:
            self.row = []
        spans = {k.lower(): max(int(v), 1) for k, v in _SPAN.findall(attrs)} if attrs else {}
        self.cell = [[], tag, spans.get("colspan", 1), spans.get("rowspan", 1)]
        self.row.append(self.cell)

    def plain_row(self, cells, unclean):
        self.end_row()
        self.sections[self.section].append(
            [(_clean(text) if unclean else text or None, tag, 1, 1) for tag, text in cells])

    def rows(self):
        """(header rows, body rows), spans filled in, all of one width; the footer ends the body."""
        head, body, foot = (self.sections[s] for s in ("thead", "tbody", "tfoot"))
        if not head:
            n = next((i for i, row in enumerate(body) if any(c[1].lower() != "th" for c in row)), len(body))
            head, body = body[:n], body[n:]
        head, body = _fill_spans(head), _fill_spans(body) + _fill_spans(foot)
        width = max(map(len, head + body), default=0)
        for row in head + body:
            row.extend([None] * (width - len(row)))
        return head, body


def _fill_spans(rows):
    if all(c[2] == 1 and c[3] == 1 for row in rows for c in row):
        return [[c[0] for c in row] for row in rows]
    filled, hanging = [], {}  # hanging: column -> (text, rows it still reaches into)
    for row in rows:
        out, cells = [], iter(row)
        while True:
            if len(out) in hanging:
                text, left = hanging.pop(len(out))
                if left > 1:
                    hanging[len(out)] = (text, left - 1)
                out.append(text)
                continue
            cell = next(cells, None)
            if cell is None:
                if any(column > len(out) for column in hanging):
                    out.append(None)
                    continue
                break
            for _ in range(cell[2]):
                if cell[3] > 1:
                    hanging[len(out)] = (cell[0], cell[3] - 1)
                out.append(cell[0])
        filled.append(out)
    # Cells that reach past the last row make rows of their own, of these cells alone.
    while hanging:
        filled.append([hanging[column][0] for column in sorted(hanging)])
        hanging = {column: (text, left - 1) for column, (text, left) in hanging.items() if left > 1}
    return filled


def _add_text(tables, text):
    for table in tables:
        if table.cell is not None:
            table.cell[0].append(text)


def read_tables(page):
    """[(header rows, body rows)] of a page in page order, nested tables included, empty ones not."""
    found, open_tables = [], []
    hidden, at = None, 0
    for token in _TOKEN.finditer(page):
        if open_tables and hidden is None and token.start() > at:
            _add_text(open_tables, page[at:token.start()])
        at = token.end()
        row = token["row"]
        if row is not None:
            if hidden is not None and hidden.meets("tr", "") == "after":
                hidden = None
            if open_tables and hidden is None:
                cells = _PLAIN_CELL.findall(row)
                _add_text(open_tables[:-1], "".join(text for _, text in cells))
                open_tables[-1].plain_row(cells, _UNCLEAN.search(row) is not None)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag, ends = tag.lower(), token["end"]
        if hidden is not None:
            met = hidden.meets(tag, ends)
            if met != "in":
                hidden = None
            if met != "after":
                continue
        attrs = token["attrs"]
        if attrs and not ends and tag not in _VOID and _HIDDEN.search(attrs):
            hidden = _Hidden(tag, bool(open_tables))
            if open_tables and tag in _IN_TABLE:
                open_tables[-1].end_cell() if tag in ("td", "th") else open_tables[-1].end_row()
            continue
        if tag == "table" and not ends:
            open_tables.append(_Table())
            found.append(open_tables[-1])
            continue
        if not open_tables:
            continue
        table = open_tables[-1]
        if tag == "td" or tag == "th":
            table.end_cell() if ends else table.start_cell(tag, attrs)
        elif tag == "tr":
            table.end_row()
            if not ends:
                table.row = []
        elif tag == "br":
            if table.cell is not None:
                table.cell[0].append(" ")
        elif tag in table.sections:
            table.end_row()
            table.section = "tbody" if ends else tag
        elif tag == "table":
            table.end_row()
            open_tables.pop()
    if open_tables and hidden is None:
        _add_text(open_tables, page[at:])
    for table in open_tables:
        table.end_row()
    tables = (table.rows() for table in found)
    return [(head, body) for head, body in tables if any(c is not None for row in head + body for c in row)]


def _page_rows(page):
    for table_idx, parts in enumerate(read_tables(page)):
        for is_header, rows in zip((True, False), parts):
            for row_idx, cells in enumerate(rows):
                yield table_idx, is_header, row_idx, len(rows), cells


# The reader travels with the job: workers need not have this package.
register_pickle_by_value(sys.modules[__name__])

_ARROW_TYPES = [pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.string())]


def _has_table(html_col):
    return F.col(html_col).rlike("(?i)<table")


def extract_html_tables(pages: DataFrame, id_cols, html_col="html", batch_rows=10000) -> DataFrame:
    """One row per table row: id columns, table_idx, is_header, row_idx, n_rows, cells.

    row_idx counts from 0 within the header or the body; n_rows is the length of that part, so the
    last row is known without a shuffle. Cells are texts, null where empty; rows of a table all have
    its width. The only operator that needs Python workers: pages without a table are not sent to
    them, a page is parsed alone, and rows are handed on every batch_rows rows, so memory follows the
    largest batch of pages: spark.sql.execution.arrow.maxBytesPerBatch, which `build_session` sets, or one page.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    kept = pages.filter(_has_table(html_col)).select(*id_cols, F.col(html_col).alias("_html"))
    schema = T.StructType([pages.schema[c] for c in id_cols] + TABLE_FIELDS)
    names = schema.names

    def emit(batch, sources, rows):
        ids = [batch.column(c).take(pa.array(sources, pa.int32())) for c in id_cols]
        values = [pa.array(column, kind) for column, kind in zip(zip(*rows), _ARROW_TYPES)]
        return pa.RecordBatch.from_arrays(ids + values, names)

    def parse(batches):
        for batch in batches:
            sources, rows = [], []
            for i, page in enumerate(batch.column("_html")):
                for row in _page_rows(page.as_py()):
                    sources.append(i)
                    rows.append(row)
                    if len(rows) >= batch_rows:
                        yield emit(batch, sources, rows)
                        sources, rows = [], []
            if rows:
                yield emit(batch, sources, rows)

    return kept.mapInArrow(parse, schema)


# The entities that occur in addresses and names; the ampersand comes last, so that nothing is decoded twice.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#38;", "&"), ("&amp;", "&")]


def rows_by_header(tables: DataFrame, id_cols, names) -> DataFrame:
    """Body rows of all tables of a page under their header's names: id columns, table_idx, row_idx and the names.

    Names a table does not have are null; of equal names in a header the first counts. Tables without a header give nulls.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    place = [*id_cols, "table_idx"]
    headers = tables.filter("is_header AND row_idx = 0").select(*place, F.col("cells").alias("_header"))
    named = tables.filter("NOT is_header").join(headers, place, "left")
    at = lambda name: F.array_position("_header", F.lit(name)).cast("int")
    return named.select(*place, "row_idx", *[F.when(at(n) > 0, F.get("cells", at(n) - 1)).alias(n) for n in names])


def _let(value, use):
    """`use(value)`, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _running(values, combine) -> Column:
    """What `combine` makes of the values up to each place, in steps that double their reach; arrays of up to 2**30 values."""
    def step(x, k):
        reach = F.pow(F.lit(2), k).cast("int")
        return F.when(F.size(x) <= reach, x).otherwise(F.transform(x, lambda v, i: F.when(i >= reach, combine(v, F.get(x, i - reach))).otherwise(v)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(29)), values, step)


def _elements(marks, matches) -> Column:
    """(at, to) of each opening mark that matches: its place among the marks and that of its end mark, or of the end of the page.

    Depths are running sums; marks that would end more than was begun are left out. Marks of one depth stand in turn for a beginning
    and an end, so an element's end is the next mark of its depth.
    """
    opens = F.transform(marks, lambda m: F.when(F.substring(m, 2, 1) == "/", -1).otherwise(1))
    add, low = (lambda a, b: a + b), (lambda a, b: F.least(a, b))

    def placed(signs):
        def with_sums(sums):
            def with_lows(lows):
                # How often something was ended that had not begun, up to here.
                stray = F.transform(lows, lambda x: F.least(x, F.lit(0)))
                return _let(stray, lambda s: F.filter(F.transform(signs, lambda sign, i: F.struct(
                    (F.get(sums, i) - F.get(s, i) + F.when(sign < 0, 1).otherwise(0)).alias("depth"), i.alias("at"), sign.alias("sign"),
                    ((sign < 0) & (F.get(s, i) < F.coalesce(F.get(s, i - 1), F.lit(0)))).alias("stray"))), lambda m: ~m["stray"]))
            return _let(_running(sums, low), with_lows)
        return _let(_running(signs, add), with_sums)

    def found(ordered):
        ends = F.transform(ordered, lambda m, i: F.struct(m["at"].alias("at"), m["sign"].alias("sign"), F.when(
            F.get(ordered, i + 1)["depth"] == m["depth"], F.get(ordered, i + 1)["at"]).otherwise(F.size(marks)).alias("to")))
        return F.array_sort(F.filter(ends, lambda m: (m["sign"] > 0) & matches(F.get(marks, m["at"]))))
    return _let(F.sort_array(_let(opens, placed)), found)


def element_texts(html_col, tag, css_class) -> Column:
    """Texts of the elements of a tag and class, in the order in which they begin; white space becomes one space.

    An element goes to its own end mark, over elements of its tag within it; those that match are given as well, after it. Tags inside are dropped. An
    element without an end mark goes to the end of the page, an end mark without an element is left out. Attribute values may be quoted
    or bare. A page without the class is not looked at any further.
    """
    mark = rf"""(?is)</?{tag}(?=[\s/>])(?:(?:[^"'>]++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*+>)"""
    value = rf"""(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}(?=[\s/>]))"""
    attribute = rf"""(?is)^<{tag}\s(?:(?:[^"'>]|"[^"<]*+"|'[^'<]*+')*?\s)?class\s*=\s*{value}"""
    page = F.col(html_col) if isinstance(html_col, str) else html_col

    def text(inner):
        plain = F.trim(F.regexp_replace(F.regexp_replace(inner, "<[^>]*>", ""), r"\s+", " "))
        return reduce(lambda t, entity: F.replace(t, F.lit(entity[0]), F.lit(entity[1])), _ENTITIES, plain)

    def of_marks(marks):
        between = F.split(page, mark, -1)  # what stands behind mark i is number i + 1
        found = _elements(marks, lambda m: m.rlike(attribute))
        return _let(between, lambda parts: F.transform(found, lambda e: text(F.array_join(F.slice(parts, e["at"] + 2, e["to"] - e["at"]), ""))))
    nothing = F.array().cast("array<string>")
    some = _let(F.regexp_extract_all(page, F.lit(mark), F.lit(0)), of_marks)
    return F.when(page.isNull(), None).when(~F.contains(F.lower(page), F.lit(css_class.lower())), nothing).otherwise(some)


def pages_without_tables(pages: DataFrame, html_col="html") -> DataFrame:
    """Pages to reject: nothing to read in them."""
    return pages.filter(~F.coalesce(_has_table(html_col), F.lit(False)))


#: The target of an anchor: quoted either way or bare, in any case.
_ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _targets(html_col):
    def plain(link):
        link = F.regexp_replace(link, r"""^["']|["']$""", "")
        decoded = reduce(lambda text, entity: F.replace(text, F.lit(entity[0]), F.lit(entity[1])), _ENTITIES, link)
        return F.when(link.contains("&"), decoded).otherwise(link)
    return F.transform(F.regexp_extract_all(F.col(html_col), F.lit(_ANCHOR), F.lit(1)), plain)


def extract_links(pages: DataFrame, id_cols, html_col="html", containing=None) -> DataFrame:
    """One row per anchor target: id columns, link_idx, link."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    links = _targets(html_col)
    if containing is not None:
        links = F.filter(links, lambda link: link.contains(containing))
    return pages.select(*id_cols, F.posexplode(links).alias("link_idx", "link"))


def count_links(pages: DataFrame, id_cols, html_col="html") -> DataFrame:
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return pages.select(*id_cols, F.regexp_count(F.col(html_col), F.lit(_ANCHOR)).alias("n_links"))
