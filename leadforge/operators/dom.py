"""H1: HTML parse into a per-page DOM row.

``parse_pages`` turns ``(url, html)`` rows into one row per page:

    url, text, stext, elems array<struct<...>>

``text``  -- all text nodes in document order, glued with no separator
             (``get_text()`` of the document).  Script, style and template
             contents and comments are not text.
``stext`` -- every text node stripped, empty ones dropped, glued with no
             separator (``get_text(strip=True)``).
``elems`` -- the elements in document (pre-order) order.  ``id`` starts at 1;
             the document itself is the implicit element 0.  ``end`` is the id
             of the last descendant, so ``b`` is inside ``a`` iff
             ``a.id < b.id <= a.end``.  ``prev`` is the previous element
             sibling (0 if none).  Element ``i`` sits at array index ``i - 1``.  ``tf/tt`` and ``sf/st`` are the element's
             text range in ``text`` and ``stext``.  ``raw`` holds a script's
             content and is NULL for every other tag.

The only Python in the engine's hot path is this tree builder; every operator
after it is a Spark expression over the row.  Tree rules (those of the stdlib
``html.parser`` tree builder): void tags never nest; an end tag closes up to the
nearest open tag of that name and is ignored if there is none; EOF closes
everything; a repeated attribute keeps the last value; ``class`` splits on
whitespace; character references are decoded.

Keeping a page's elements in one row means that all page-local work
(selectors, descendant tests, "first in document order", sibling lookups) runs
without a shuffle: a page never has to be re-assembled from exploded rows.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENT_TYPE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("prev", T.IntegerType()),
        T.StructField("nspan", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("cls", T.ArrayType(T.StringType())),
        T.StructField("tf", T.IntegerType()),
        T.StructField("tt", T.IntegerType()),
        T.StructField("sf", T.IntegerType()),
        T.StructField("st", T.IntegerType()),
        T.StructField("raw", T.StringType()),
    ]
)

# The texts are UTF-8 bytes and the offsets count bytes, so that an element's
# text costs its own length: in a string, every slice walks from the start.
DOM_FIELDS = [
    T.StructField("btext", T.BinaryType()),
    T.StructField("bstext", T.BinaryType()),
    T.StructField("elems", T.ArrayType(ELEMENT_TYPE)),
]

VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Text inside these tags (at any depth) is not ordinary text: the tree
# builder gives it its own string class, and get_text() of ordinary elements
# and of the document leaves it out.
NON_TEXT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
# A text node of these characters alone is one line feed if it holds one, else
# one space, but not inside these tags.
_BLANK = " \n\t\f\r"
_KEEP_BLANK_TAGS = frozenset(["pre", "textarea"])
_OUTPUT_CHUNK_ROWS = 256

# Plain markup, on which every version of the stdlib tokenizer agrees: text, start
# tags with quoted attributes free of references, end tags, short comments, a
# document type.  What follows the first other "<" is the last group.
_PLAIN = re.compile(
    r"""([^<]+)
    |<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][-:\w]*(?:="[^"&]*")?)*)[ \t\n]*(/?)>
    |</([a-zA-Z][a-zA-Z0-9]*)>
    |(<!--[^<>-]+(?:-[^<>-]+)*-->|<![dD][oO][cC][tT][yY][pP][eE]\ [a-zA-Z]+>)
    |(<[\s\S]*)""", re.ASCII | re.VERBOSE)
_ATTRIBUTE = re.compile(r'([a-zA-Z][-:\w]*)(?:="([^"]*)")?', re.ASCII)
# Their content is plain only up to their own end tag, without other markup.
_RAW_TAGS = frozenset(["script", "style", "title", "textarea"])
_NEVER_PLAIN = frozenset(["iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"])


def _plain_tokens(html: str) -> list[tuple[str, ...]] | None:
    """The page's tokens ``(text, start tag, attributes, slash, end tag, comment
    or declaration, rest)``, one of them set in each; None for other markup."""
    tokens = _PLAIN.findall(html)
    if not tokens:
        return tokens
    if tokens[-1][6]:
        return None
    for i, token in enumerate(tokens):
        tag = token[1].lower()
        if tag in _RAW_TAGS:
            after = tokens[i + 1 : i + 3]
            if after and after[0][0]:
                after = after[1:]
            if token[3] or not after or after[0][4].lower() != tag:
                return None
        elif tag in _NEVER_PLAIN:
            return None
    return tokens


class _TreeBuilder(HTMLParser):
    """Builds the elements of many pages into flat, column-oriented lists
    (one entry per element; list-valued fields as values + offsets), so an
    Arrow batch is assembled without per-element Python objects."""

    def __init__(self, sep: str = "") -> None:
        super().__init__(convert_charrefs=True)
        self.sep = sep                     # between text nodes
        # element columns, for every page fed so far
        self.end: list[int] = []
        self.parent: list[int] = []
        self.prev: list[int] = []
        self.nspan: list[int] = []
        self.tag: list[str] = []
        self.attr_keys: list[str] = []
        self.attr_vals: list[str] = []
        self.attr_off: list[int] = [0]
        self.cls_vals: list[str] = []
        self.cls_off: list[int] = [0]
        self.tf: list[int] = []
        self.tt: list[int] = []
        self.sf: list[int] = []
        self.st: list[int] = []
        self.raw: list[str | None] = []

    # -- per page --------------------------------------------------------------
    _COLUMNS = ("end", "parent", "prev", "nspan", "tag", "attr_keys", "attr_vals", "attr_off", "cls_vals", "cls_off",
                "tf", "tt", "sf", "st", "raw")

    def page_or_none(self, html: str) -> tuple[str, str] | None:
        """``page`` that treats markup the tokenizer rejects (it raises on some
        malformed declarations, e.g. ``<![if``) as a failed fetch: the page's
        partial rows are rolled back and ``None`` is returned."""
        elems, attrs, classes = len(self.tag), len(self.attr_keys), len(self.cls_vals)
        try:
            return self.page(html)
        except Exception:  # noqa: BLE001 - any rejection = the page could not be read
            for c in self._COLUMNS:
                mark = attrs if c in ("attr_keys", "attr_vals") else classes if c == "cls_vals" else elems + (c in ("attr_off", "cls_off"))
                del getattr(self, c)[mark:]
            return None

    def page(self, html: str) -> tuple[str, str]:
        """Parse one document; returns ``(text, stext)``."""
        self.reset()
        self.base = len(self.tag)          # index of this page's element 1
        self.stack: list[int] = []         # ids of open elements
        self.last_child: dict[int, int] = {}
        self.before_span: dict[int, list[int]] = {}  # children since the parent's last span
        self.text: list[str] = []
        self.text_len = 0
        self.stext: list[str] = []
        self.stext_len = 0
        self.pending: list[str] = []
        self.in_container = 0              # open NON_TEXT_TAGS elements
        self.keep_blank = 0                # open _KEEP_BLANK_TAGS elements
        tokens = _plain_tokens(html)
        if tokens is None:
            self.feed(html)
            self.close()
        else:
            self._feed_plain(tokens)
        self._flush()
        self._close_to(0)
        return "".join(self.text), "".join(self.stext)

    def _feed_plain(self, tokens: list[tuple[str, ...]]) -> None:
        """What ``feed`` and ``close`` do with plain markup, in a fraction of their time."""
        raw = False
        for text, tag, attrs, slash, end, _, _ in tokens:
            if text:
                # a run of text lies between two pieces of markup: nothing to wait for
                self._add_text(unescape(text) if "&" in text and not raw else text)
            elif end:
                raw = False
                self.handle_endtag(end.lower())
            elif tag:
                tag = tag.lower()
                found = [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else ()
                if slash:
                    self._open(tag, found)
                else:
                    self.handle_starttag(tag, found)
                    raw = tag == "script" or tag == "style"

    # -- text --------------------------------------------------------------------
    def _flush(self) -> None:
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending = []
        self._add_text(data)

    def _add_text(self, data: str) -> None:
        if self.in_container:
            i = self.base + self.stack[-1] - 1
            if self.tag[i] == "script":
                self.raw[i] += data
            return
        if not self.keep_blank and not data.strip(_BLANK):
            data = "\n" if "\n" in data else " "
        if self.sep and self.text:
            data = self.sep + data
        self.text.append(data)
        self.text_len += len(data) if data.isascii() else len(data.encode())
        stripped = data[len(self.sep):].strip() if self.sep and len(self.text) > 1 else data.strip()
        if stripped:
            self.stext.append(stripped)
            self.stext_len += len(stripped) if stripped.isascii() else len(stripped.encode())

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        if self.pending:
            self._flush()

    def handle_decl(self, decl: str) -> None:
        self._flush()

    def handle_pi(self, data: str) -> None:
        self._flush()

    def unknown_decl(self, data: str) -> None:
        self._flush()

    # -- tags ----------------------------------------------------------------------
    def _open(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if self.pending:
            self._flush()
        tags = self.tag
        eid = len(tags) - self.base + 1
        stack = self.stack
        parent = stack[-1] if stack else 0
        self.end.append(eid)
        self.parent.append(parent)
        last_child = self.last_child
        self.prev.append(last_child.get(parent, 0))
        self.nspan.append(0)
        waiting = self.before_span.get(parent)
        if waiting is None:
            waiting = self.before_span[parent] = []
        if tag == "span":
            for sibling in waiting:
                self.nspan[self.base + sibling - 1] = eid
            waiting.clear()
        waiting.append(eid)
        tags.append(tag)
        if attrs:
            amap = dict(attrs)  # a repeated attribute keeps its last value
            if None in amap.values():
                amap = {k: ("" if v is None else v) for k, v in amap.items()}
            self.attr_keys.extend(amap)
            self.attr_vals.extend(amap.values())
            cls = amap.get("class")
            if cls is not None:
                self.cls_vals.extend(cls.split())
        self.attr_off.append(len(self.attr_keys))
        self.cls_off.append(len(self.cls_vals))
        tl, sl = self.text_len, self.stext_len
        self.tf.append(tl)
        self.tt.append(tl)
        self.sf.append(sl)
        self.st.append(sl)
        self.raw.append("" if tag == "script" else None)
        last_child[parent] = eid
        return eid

    def _close_to(self, depth: int) -> None:
        last_id = len(self.tag) - self.base
        stack = self.stack
        while len(stack) > depth:
            i = self.base + stack.pop() - 1
            tag = self.tag[i]
            if tag in NON_TEXT_TAGS:
                self.in_container -= 1
            elif tag in _KEEP_BLANK_TAGS:
                self.keep_blank -= 1
            self.end[i] = last_id
            self.tt[i] = self.text_len
            self.st[i] = self.stext_len

    def handle_starttag(self, tag: str, attrs) -> None:
        eid = self._open(tag, attrs)
        if tag not in VOID_TAGS:
            self.stack.append(eid)
            if tag in NON_TEXT_TAGS:
                self.in_container += 1
            elif tag in _KEEP_BLANK_TAGS:
                self.keep_blank += 1

    def handle_startendtag(self, tag: str, attrs) -> None:
        self._open(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.pending:
            self._flush()
        stack, tags, base = self.stack, self.tag, self.base - 1
        for depth in range(len(stack) - 1, -1, -1):
            if tags[base + stack[depth]] == tag:
                self._close_to(depth)
                return

    # -- Arrow -----------------------------------------------------------------------
    def elements_array(self, page_off: list[int], missing: list[bool], elems_type: pa.DataType) -> pa.Array:
        """``list<struct>`` array of all pages fed (offsets per page)."""
        i32 = pa.int32()
        n = len(self.tag)
        ids = [0] * n
        for p in range(len(page_off) - 1):
            a, b = page_off[p], page_off[p + 1]
            ids[a:b] = range(1, b - a + 1)
        struct_type = elems_type.value_type
        children = [
            pa.array(ids, i32), pa.array(self.end, i32), pa.array(self.parent, i32), pa.array(self.prev, i32),
            pa.array(self.nspan, i32), pa.array(self.tag, pa.string()),
            pa.MapArray.from_arrays(pa.array(self.attr_off, i32), pa.array(self.attr_keys, pa.string()),
                                    pa.array(self.attr_vals, pa.string())),
            pa.ListArray.from_arrays(pa.array(self.cls_off, i32), pa.array(self.cls_vals, pa.string())),
            pa.array(self.tf, i32), pa.array(self.tt, i32), pa.array(self.sf, i32), pa.array(self.st, i32),
            pa.array(self.raw, pa.string()),
        ]
        children = [c.cast(f.type) for c, f in zip(children, struct_type)]
        struct = pa.StructArray.from_arrays(children, fields=list(struct_type))
        return pa.ListArray.from_arrays(pa.array(page_off, i32), struct, type=elems_type,
                                        mask=pa.array(missing, pa.bool_()))


def parse_html(html: str | None) -> tuple[str | None, str | None, list[dict] | None]:
    """Parse one document into ``(text, stext, elements as dicts)`` (helper for
    tests; the Spark path builds Arrow columns directly)."""
    if html is None:
        return None, None, None
    b = _TreeBuilder()
    parsed = b.page_or_none(html)
    if parsed is None:
        return None, None, None
    text, stext = parsed
    elems = []
    for i in range(len(b.tag)):
        a0, a1 = b.attr_off[i], b.attr_off[i + 1]
        elems.append({
            "id": i + 1, "end": b.end[i], "parent": b.parent[i], "prev": b.prev[i], "nspan": b.nspan[i],
            "tag": b.tag[i],
            "attrs": list(zip(b.attr_keys[a0:a1], b.attr_vals[a0:a1])),
            "cls": b.cls_vals[b.cls_off[i]:b.cls_off[i + 1]],
            "tf": b.tf[i], "tt": b.tt[i], "sf": b.sf[i], "st": b.st[i], "raw": b.raw[i],
        })
    return text, stext, elems


def _dom_schema(pages: DataFrame, keep: list[str], keep_html: bool) -> T.StructType:
    fields = [pages.schema[c] for c in keep]
    if keep_html:
        fields.append(T.StructField("html", T.StringType()))
    return T.StructType(fields + DOM_FIELDS)


def parse_pages(pages: DataFrame, keep: list[str] | None = None, keep_html: bool = False, sep: str = "") -> DataFrame:
    """H1: ``pages(url, html, ...)`` -> one DOM row per page.

    ``keep`` columns (default ``["url"]``) pass through unchanged; ``html`` is
    passed on only when ``keep_html`` (the engine's own raw-HTML patterns run
    before the parse instead, so the HTML need not come back).  A NULL
    ``html`` (fetch failed / page missing) yields NULL DOM columns.  ``sep``
    stands between the text nodes of ``text`` (none by default, as the reproduced
    tool glues neighbouring blocks, quirk K7); an element's text may begin with it.
    """
    keep = list(keep or ["url"])
    schema = _dom_schema(pages, keep, keep_html)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)
    dom_types = [arrow_schema.field(f.name).type for f in DOM_FIELDS]
    n_keep = len(keep)

    def run(batches):
        for batch in batches:
            htmls = batch.column(n_keep).to_pylist()
            for start in range(0, batch.num_rows, _OUTPUT_CHUNK_ROWS):
                part = htmls[start : start + _OUTPUT_CHUNK_ROWS]
                builder = _TreeBuilder(sep)
                texts, stexts, page_off, missing = [], [], [0], []
                for h in part:
                    parsed = None if h is None else builder.page_or_none(h)
                    if parsed is None:  # missing page, or markup the tokenizer rejects
                        texts.append(None)
                        stexts.append(None)
                        missing.append(True)
                    else:
                        texts.append(parsed[0].encode())
                        stexts.append(parsed[1].encode())
                        missing.append(False)
                    page_off.append(len(builder.tag))
                cols = [batch.column(i).slice(start, len(part)) for i in range(n_keep)]
                if keep_html:
                    cols.append(batch.column(n_keep).slice(start, len(part)))
                cols.append(pa.array(texts, dom_types[0]))
                cols.append(pa.array(stexts, dom_types[1]))
                cols.append(builder.elements_array(page_off, missing, dom_types[2]))
                yield pa.RecordBatch.from_arrays(cols, schema=arrow_schema)

    dom = pages.select(*keep, "html").mapInArrow(run, schema)
    return dom.withColumns({"text": F.col("btext").cast("string"), "stext": F.col("bstext").cast("string")})


def elements(dom: DataFrame) -> DataFrame:
    """Relational view of the DOM: one row per element (for counts and tests)."""
    return dom.select("url", F.inline("elems"))


def read_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed ``pages`` table of a test-data directory."""
    from leadforge.sources.pages import read_pages

    return parse_pages(read_pages(spark, sf_dir))
