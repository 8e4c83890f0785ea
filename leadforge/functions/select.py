"""H2/H3: selectors as data records, compiled to Spark predicates.

A selector is a ``Sel`` record: the simple parts (tag, id, classes, attribute
tests, ``:not`` tests, ``:contains`` text) plus at most one combinator to the
left (``inside`` = descendant, ``after`` = adjacent sibling).  A comma list is
a tuple of records (``any_of``).  Records are turned into Column expressions on
the element struct of ``leadforge.operators.dom`` (as one SQL expression) when
the plan is built, so a selector costs no Python at run time.  ``css()`` renders a record for reports.

On a DOM row:
  ``select(sel)``      -> array of matching elements in document order (each
                          element once, as a comma list does);
  ``select_one(sel)``  -> the first of them (or NULL);
  ``raw_text(e)``      -> ``get_text()`` of an element;
  ``strip_text(e)``    -> ``get_text(strip=True)`` of an element.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_COL = "text"
BYTES_COL = "btext"
STRIPPED_BYTES_COL = "bstext"
ELEMS_COL = "elems"


@dataclass(frozen=True)
class Sel:
    tag: str | None = None
    id: str | None = None
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str, str | None], ...] = ()  # (name, op, value); op in has = *= ^= $=
    nots: tuple["Sel", ...] = ()
    contains: str | None = None
    inside: "Sel | None" = None
    after: "Sel | None" = None

    def css(self) -> str:
        out = ""
        if self.inside is not None:
            out += self.inside.css() + " "
        if self.after is not None:
            out += self.after.css() + " + "
        simple = self.tag or ""
        if self.id:
            simple += "#" + self.id
        simple += "".join("." + c for c in self.classes)
        for name, op, value in self.attrs:
            simple += f"[{name}]" if op == "has" else f'[{name}{op}"{value}"]'
        for n in self.nots:
            simple += f":not({n.css()})"
        if self.contains is not None:
            simple += f':contains("{self.contains}")'
        return out + (simple or "*")


Selector = Union[Sel, tuple]


def sel(tag: str | None = None, *, id: str | None = None, cls: str | tuple = (), attrs=(), nots=(),
        contains: str | None = None, inside: Selector | None = None, after: Selector | None = None) -> Sel:
    """Short constructor: ``sel('a', attrs=[('href', '*=', 'pg-')], inside=sel(cls='pagination'))``."""
    classes = (cls,) if isinstance(cls, str) else tuple(cls)
    attr_t = tuple((a[0], "has", None) if len(a) == 1 else (a[0], a[1], a[2]) for a in attrs)
    return Sel(tag, id, classes, attr_t, tuple(nots), contains, inside, after)


def any_of(*sels: Sel) -> tuple:
    return tuple(sels)


def css(s: Selector) -> str:
    return ", ".join(x.css() for x in s) if isinstance(s, tuple) else s.css()


# -- element accessors ---------------------------------------------------------

def attr(e: Column, name: str) -> Column:
    """Attribute value or NULL.  ``class`` is the joined class list."""
    if name == "class":
        return F.when(F.size(e["cls"]) > 0, F.array_join(e["cls"], " "))
    return e["attrs"][name]


def raw_text(e: Column) -> Column:
    return F.substr(F.col(BYTES_COL), e["tf"] + 1, e["tt"] - e["tf"]).cast("string")


def strip_text(e: Column) -> Column:
    return F.substr(F.col(STRIPPED_BYTES_COL), e["sf"] + 1, e["st"] - e["sf"]).cast("string")


# -- compilation to one SQL expression ---------------------------------------------
#
# A selector becomes ``filter(elems, _sel -> <predicate>)``.  A descendant
# test ("inside B") needs the elements that match B: that list is computed
# once per page and bound to a lambda variable with a one-element
# ``transform(array(<list>), _inN -> ...)``.  Its outermost matches are disjoint
# intervals ``(b.id, b.end]``; they are spread into one flag an element, so a test
# is one lookup, and a page costs its elements and its matches, not their product.

def _q(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _attr_sql(v: str, name: str) -> str:
    if name == "class":
        return f"(CASE WHEN size({v}.cls) > 0 THEN array_join({v}.cls, ' ') END)"
    return f"{v}.attrs[{_q(name)}]"


def _attr_test_sql(v: str, name: str, op: str, value: str | None) -> str:
    if name == "class" and op == "has":
        return f"(size({v}.cls) > 0)"
    if op == "has":
        return f"map_contains_key({v}.attrs, {_q(name)})"
    a = _attr_sql(v, name)
    if op == "=":
        return f"coalesce({a} = {_q(value)}, false)"
    if not value:  # [a*=""], [a^=""], [a$=""] match nothing
        return "false"
    fn = {"*=": "contains", "^=": "startswith", "$=": "endswith"}[op]
    return f"coalesce({fn}({a}, {_q(value)}), false)"


class _Bindings:
    """Flags of descendant-test selectors, bound once per page.

    One may use others (``A B C``: the flags for ``B`` need those for ``A``), so
    each has a level: all of a level are fields of one struct, bound outside the
    levels that use it.  The nesting follows the selectors' depth, not their
    number."""

    def __init__(self) -> None:
        self.levels: dict[int, list[tuple[str, str]]] = {}
        self.by_sel: dict = {}
        self.below: list[int] = []  # of each list being built, the highest level it uses
        self.n = 0

    def fresh(self, prefix: str) -> str:
        self.n += 1
        return f"{prefix}{self.n}"

    def bind(self, inner: Selector) -> str:
        if inner not in self.by_sel:
            self.below.append(0)
            x = self.fresh("_x")
            flags = cover_sql(f"filter({ELEMS_COL}, {x} -> {pred_sql(inner, x, self)})", self)
            level, name = self.below.pop() + 1, self.fresh("_in")
            self.levels.setdefault(level, []).append((name, flags))
            self.by_sel[inner] = level, f"_level{level}.{name}"
        level, ref = self.by_sel[inner]
        if self.below:
            self.below[-1] = max(self.below[-1], level)
        return ref

    def wrap(self, expr: str) -> str:
        for level in sorted(self.levels, reverse=True):
            fields = ", ".join(f"'{name}', {flags}" for name, flags in self.levels[level])
            expr = f"get(transform(array(named_struct({fields})), _level{level} -> {expr}), 0)"
        return expr


def cover_sql(matches: str, b: _Bindings) -> str:
    """For each element (by id, from 0) up to the last covered one: whether it
    lies inside a match.  ``matches`` are in document order."""
    acc, x, o, k, i = (b.fresh(p) for p in ("_acc", "_m", "_o", "_k", "_out"))
    none = "CAST(array() AS array<struct<id:int,end:int>>)"
    outer = (f"aggregate({matches}, {none}, ({acc}, {x}) -> CASE WHEN size({acc}) > 0 AND {x}.id <= element_at({acc}, -1).end THEN {acc} "
             f"ELSE array_append({acc}, named_struct('id', {x}.id, 'end', {x}.end)) END)")
    before = f"CASE WHEN {k} = 0 THEN 0 ELSE get({i}, {k} - 1).end + 1 END"
    flags = f"flatten(transform({i}, ({o}, {k}) -> concat(array_repeat(false, {o}.id + 1 - {before}), array_repeat(true, {o}.end - {o}.id))))"
    return f"get(transform(array({outer}), {i} -> {flags}), 0)"


def pred_sql(s: Selector, v: str, b: _Bindings) -> str:
    """SQL predicate: element expression ``v`` matches selector ``s``."""
    if isinstance(s, tuple):
        return "(" + " OR ".join(pred_sql(x, v, b) for x in s) + ")"
    conds: list[str] = []
    if s.tag:
        conds.append(f"{v}.tag = {_q(s.tag)}")
    if s.id:
        conds.append(f"coalesce({v}.attrs['id'] = {_q(s.id)}, false)")
    for c in s.classes:
        conds.append(f"array_contains({v}.cls, {_q(c)})")
    for name, op, value in s.attrs:
        conds.append(_attr_test_sql(v, name, op, value))
    for n in s.nots:
        conds.append(f"NOT {pred_sql(n, v, b)}")
    if s.contains is not None:
        conds.append(f"contains(cast(substr({BYTES_COL}, {v}.tf + 1, {v}.tt - {v}.tf) AS string), {_q(s.contains)})")
    if s.after is not None:
        prev = f"(get({ELEMS_COL}, {v}.prev - 1))"
        conds.append(f"coalesce({v}.prev > 0 AND {pred_sql(s.after, prev, b)}, false)")
    if s.inside is not None:
        conds.append(f"coalesce(get({b.bind(s.inside)}, {v}.id), false)")
    return "(" + (" AND ".join(conds) if conds else "true") + ")"


def select_sql(s: Selector) -> str:
    b = _Bindings()
    pred = pred_sql(s, "_sel", b)
    hits = b.wrap(f"filter({ELEMS_COL}, _sel -> {pred})")
    if isinstance(s, Sel) and s.contains is not None:
        # most pages do not hold the text at all: one test before any element's
        hits = f"(CASE WHEN contains({TEXT_COL}, {_q(s.contains)}) THEN {hits} ELSE slice({ELEMS_COL}, 1, 0) END)"
    return hits


def select(s: Selector) -> Column:
    """Matching elements of the page, in document order (one SQL expression)."""
    return F.expr(select_sql(s))


def _tag(s: Selector) -> str | None:
    """The tag that every match of ``s`` has, if it names one."""
    tags = {x.tag for x in (s if isinstance(s, tuple) else (s,))}
    return tags.pop() if len(tags) == 1 else None


def select_many(selectors: list[Selector]) -> Column:
    """``select`` of each selector, as an array of match lists.

    Selectors are bucketed by tag: the page is read once for the elements of
    each tag that is named, and a selector reads those of its own tag alone.
    Match lists of descendant tests are shared by all that use them, and a
    selector whose ``contains`` text the page lacks reads nothing."""
    b = _Bindings()
    buckets = {tag: f"_tags.{tag}" for tag in map(_tag, selectors) if tag}
    hits = []
    for s in selectors:
        source = buckets.get(_tag(s) or "", ELEMS_COL)
        x = b.fresh("_sel")
        own = f"filter({source}, {x} -> {pred_sql(s, x, b)})"
        if isinstance(s, Sel) and s.contains is not None:
            own = f"(CASE WHEN contains({TEXT_COL}, {_q(s.contains)}) THEN {own} ELSE slice({ELEMS_COL}, 1, 0) END)"
        hits.append(own)
    expr = b.wrap(f"array({', '.join(hits)})")
    if buckets:
        x = b.fresh("_x")
        fields = ", ".join(f"'{tag}', filter({ELEMS_COL}, {x} -> {x}.tag = {_q(tag)})" for tag in buckets)
        expr = f"get(transform(array(named_struct({fields})), _tags -> {expr}), 0)"
    return F.expr(expr)


def _record_sql(v: str, r: str, b: _Bindings) -> str:
    """SQL predicate: element ``v`` matches the simple selector *record* ``r`` (a
    struct of ``sources.config.SELECTOR``): what ``pred_sql`` is for one that is
    known when the plan is built."""
    c, a = b.fresh("_c"), b.fresh("_t")
    value = f"(CASE WHEN {a}.name = 'class' THEN {_attr_sql(v, 'class')} ELSE {v}.attrs[{a}.name] END)"
    has = f"(CASE WHEN {a}.name = 'class' THEN size({v}.cls) > 0 ELSE map_contains_key({v}.attrs, {a}.name) END)"
    some = f"coalesce({a}.value, '') <> ''"
    test = (f"CASE coalesce({a}.op, 'has') WHEN 'has' THEN {has} WHEN '=' THEN {value} = {a}.value WHEN '*=' THEN {some} AND contains({value}, {a}.value) "
            f"WHEN '^=' THEN {some} AND startswith({value}, {a}.value) WHEN '$=' THEN {some} AND endswith({value}, {a}.value) ELSE false END")
    return (f"((coalesce({r}.tag, '') = '' OR {v}.tag = {r}.tag) AND (coalesce({r}.id, '') = '' OR coalesce({v}.attrs['id'] = {r}.id, false)) "
            f"AND ({r}.classes IS NULL OR forall({r}.classes, {c} -> array_contains({v}.cls, {c}))) "
            f"AND ({r}.attrs IS NULL OR forall({r}.attrs, {a} -> coalesce({test}, false))) "
            f"AND ({r}.contains IS NULL OR contains(cast(substr({BYTES_COL}, {v}.tf + 1, {v}.tt - {v}.tf) AS string), {r}.contains)))")


def select_by(record: str) -> Column:
    """Elements matching the selector record in column ``record`` (one of
    each row): the plan is the same however many records there are."""
    b = _Bindings()
    x, cov = b.fresh("_x"), b.fresh("_in")
    cover = cover_sql(f"filter({ELEMS_COL}, {x} -> {_record_sql(x, f'{record}.inside', b)})", b)
    inside = f"CASE WHEN {record}.inside IS NULL THEN CAST(array() AS array<boolean>) ELSE {cover} END"
    hits = f"filter({ELEMS_COL}, _sel -> {_record_sql('_sel', record, b)} AND ({record}.inside IS NULL OR coalesce(get({cov}, _sel.id), false)))"
    return F.expr(f"get(transform(array({inside}), {cov} -> {hits}), 0)")


def select_one(s: Selector) -> Column:
    return F.get(select(s), 0)


def count(s: Selector) -> Column:
    return F.size(select(s))


def within(outer: Column, inner_list: Column) -> Column:
    """Elements of ``inner_list`` that lie inside element ``outer``."""
    return F.filter(inner_list, lambda x: (x["id"] > outer["id"]) & (x["id"] <= outer["end"]))
