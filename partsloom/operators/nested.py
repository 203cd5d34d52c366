"""Problem 1: deeply nested element metadata into related flat tables.

A bottom-up tree automaton reads every metadata tree. Its symbols are the node levels
(span, line, region, element), its states are the structural variants of a level, and a
transition picks a node's state from the node's own kind and fields and from the states
its children ended in. `compile_tree` turns the transition table into one JVM expression
over VARIANT values, so a row is parsed once and every node leaves it with its state.
Every node is routed by its state: `routed` gives the keys of chosen subtype tables in one
scan, `flat_tables` the tables themselves, a supertype table per level (keys, parent link,
state, fields all variants share), one typed subtype table per variant, and tables of the lists
below elements and spans.

Defined results
    null metadata, text that is not exactly one valid JSON value: no row
    a value where an array is expected: an array of one; an empty array, null or an array
    of nulls: no child; a null entry keeps its position and is nothing
    `regions` is taken from the top, else from `layout` (an object or JSON text)
    elements delivered again: one row per node; null keys count as equal
    extra input columns, whatever their names, are left out
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsloom.functions.text import let
from partsloom.session import cut_lineage

KEYS = ("pdf_id", "element_id")


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _absent(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def _kind(v: Column) -> Column:
    """`a` for an array, `o` for an object, `n` for nothing, else `s` (a scalar)."""
    shape = F.substring(F.schema_of_variant(v), 1, 2)
    return F.when(_absent(v), "n").when(shape == "AR", "a").when(shape == "OB", "o").otherwise("s")


def items(v: Column) -> Column:
    """The children held by a field: array entries, or the single value that stands for an array."""
    none = F.array().cast("array<variant>")
    return F.when(_absent(v), none).otherwise(F.coalesce(_get(v, "$", "array<variant>"), F.array(v)))


#: A field name that stands behind a text to show that the parser got there.
_BEHIND = "behind-5b1f6d0c"


def valid_json(text: Column) -> Column:
    """The VARIANT of a text that is exactly one JSON value, else null.

    The parser stops after the first value, so trailing text would pass. Here the text stands in an array inside
    an object with a field behind it: text that closes either before its own end loses that field, text
    with a second value gives a second entry. A text that holds the field's name itself is
    parsed a second time instead, inside an object alone.
    """
    entries = lambda v: let(_get(v, "$.v", "array<variant>"), lambda a: F.when(F.size(a) == 1, a[0]))
    whole = let(
        F.try_parse_json(F.concat(F.lit('{"v":['), text, F.lit(f'],"{_BEHIND}":0}}'))),
        lambda v: F.when(_get(v, f"$['{_BEHIND}']").isNotNull(), entries(v)),
    )
    twice = F.when(
        F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull(),
        let(_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"), lambda a: F.when(F.size(a) == 1, a[0])),
    )
    return F.when(text.contains(_BEHIND), twice).otherwise(whole)


@dataclass(frozen=True)
class Transition:
    """A node of `level` enters `state` when `guard(own, kids)` holds; the first match wins.

    `own` is the node's own symbol (a span: its kind and whether it has font and refs; other
    levels: `1` if the child field holds a single value), `kids` the array of child states.
    Nothing hangs below a node in a `leaf` state. A state with `+` stands for two: with its
    level's optional group of fields (`OPTIONAL`) and without.
    """

    level: str
    state: str
    guard: Callable[[Column, Column], Column]
    leaf: bool = False


def _any(kids: Column, *names: str) -> Column:
    return F.exists(kids, lambda s: F.regexp_replace(s, _SUFFIX, "").isin(*names))


#: The optional group of fields of a level and what a state that has it is called.
OPTIONAL = {"line": ("_marked", "line_id"), "region": ("_boxed", "bbox"), "element": ("_placed", "coordinates")}
_SUFFIX = "(?:" + "|".join(s for s, _ in OPTIONAL.values()) + ")$"

#: The automaton.
TRANSITIONS = (
    Transition("span", "span_text", lambda own, kids: ~own.startswith("o"), leaf=True),
    Transition("span", "span_font_refs", lambda own, kids: own == "ofr", leaf=True),
    Transition("span", "span_font", lambda own, kids: own == "of", leaf=True),
    Transition("span", "span_refs", lambda own, kids: own == "or", leaf=True),
    Transition("span", "span_plain", lambda own, kids: F.lit(True), leaf=True),
    Transition("line", "line_bare", lambda own, kids: F.size(kids) == 0, leaf=True),
    Transition("line", "line_of_one", lambda own, kids: own == "1"),
    Transition("line", "line_mixed", lambda own, kids: _any(kids, "span_text")),
    Transition("line", "line_linked", lambda own, kids: _any(kids, "span_refs", "span_font_refs")),
    Transition("line", "line_list", lambda own, kids: F.lit(True)),
    Transition("region", "region_bare", lambda own, kids: F.size(kids) == 0, leaf=True),
    Transition("region", "region_of_one", lambda own, kids: own == "1"),
    Transition("region", "region_blank", lambda own, kids: ~F.exists(kids, lambda s: ~s.startswith("line_bare"))),
    Transition("region", "region_mixed", lambda own, kids: _any(kids, "line_mixed")),
    Transition("region", "region_list", lambda own, kids: F.lit(True)),
    Transition("element", "element_bare", lambda own, kids: F.size(kids) == 0),
    Transition("element", "element_of_one", lambda own, kids: own == "1"),
    Transition("element", "element_list", lambda own, kids: F.lit(True)),
)


def states(level: str, leaf: bool | None = None) -> list[str]:
    """All states of a level; only those that are leaves, or not, where `leaf` says so."""
    base = [t.state for t in TRANSITIONS if t.level == level and leaf in (None, t.leaf)]
    return base + [s + OPTIONAL[level][0] for s in base if level in OPTIONAL]


def _state(level: str, own: Column, children: Column | None = None, option: Column | None = None) -> Column:
    kids = F.array().cast("array<string>") if children is None else F.transform(children, lambda c: c["state"])
    out = None
    for t in TRANSITIONS:
        if t.level == level:
            cond = t.guard(own, kids)
            out = F.when(cond, t.state) if out is None else out.when(cond, t.state)
    return out if option is None else F.concat(out, F.when(_present(option), OPTIONAL[level][0]).otherwise(""))


def _single(field: Column) -> Column:
    return F.when(F.coalesce(_kind(field), F.lit("n")).isin("o", "s"), "1").otherwise("")


def _numbered(values: Column, build: Callable[[Column, Column], Column]) -> Column:
    """Children with their 0-based positions; null entries are dropped after numbering."""
    built = F.transform(values, lambda v, i: F.when(_present(v), build(i.cast("int"), v)))
    return F.filter(built, lambda e: e.isNotNull())


def _span(no: Column, v: Column, full: bool) -> Column:
    def build(kind: Column, font: Column, refs: Column) -> Column:
        own = F.concat(kind, F.when(_present(font), "f").otherwise(""), F.when(_present(refs), "r").otherwise(""))
        node = [no.alias("span_no"), _state("span", own).alias("state")]
        if not full:
            return F.struct(*node)
        ref = lambda n, r: F.struct(n.alias("ref_no"), _get(r, "$.fig", "int").alias("fig"), _get(r, "$.item", "int").alias("item"))
        return F.struct(
            *node,
            F.when(kind == "o", _get(v, "$.text", "string")).otherwise(_get(v, "$", "string")).alias("text"),
            _get(v, "$.conf", "double").alias("conf"),
            _get(font, "$.name", "string").alias("font_name"),
            _get(font, "$.size", "double").alias("font_size"),
            _numbered(items(refs), ref).alias("refs"),
        )

    return let(_kind(v), lambda k: let(_get(v, "$.font"), lambda f: let(_get(v, "$.refs"), lambda r: build(k, f, r))))


def _line(no: Column, v: Column, full: bool) -> Column:
    def build(field: Column, spans: Column) -> Column:
        node = [no.alias("line_no"), _state("line", _single(field), spans, _get(v, "$.line_id")).alias("state"), spans.alias("spans")]
        own = [_get(v, "$.line_id", "string").alias("line_id"), _get(v, "$.baseline", "double").alias("baseline")]
        return F.struct(*node, *(own if full else []))

    span = lambda n, x: _span(n, x, full)
    return let(_get(v, "$.spans"), lambda f: let(_numbered(items(f), span), lambda spans: build(f, spans)))


def _region(no: Column, v: Column, full: bool) -> Column:
    def build(field: Column, lines: Column) -> Column:
        node = [no.alias("region_no"), _state("region", _single(field), lines, _get(v, "$.bbox")).alias("state"), lines.alias("lines")]
        own = [
            _get(v, "$.region_id", "string").alias("region_id"),
            _get(v, "$.kind", "string").alias("kind"),
            _get(v, "$.score", "double").alias("score"),
            *[_get(v, f"$.bbox.{k}", "double").alias(f"bbox_{k}") for k in "xywh"],
        ]
        return F.struct(*node, *(own if full else []))

    line = lambda n, x: _line(n, x, full)
    return let(_get(v, "$.lines"), lambda f: let(_numbered(items(f), line), lambda lines: build(f, lines)))


def _element(m: Column, full: bool) -> Column:
    def build(layout: Column, field: Column, regions: Column) -> Column:
        node = [_state("element", _single(field), regions, _get(m, "$.coordinates")).alias("state"), regions.alias("regions")]
        if not full:
            return F.struct(*node)
        language = lambda n, x: F.struct(n.alias("language_no"), _get(x, "$", "string").alias("language"))
        point = lambda n, x: F.struct(n.alias("point_no"), _get(x, "$[0]", "double").alias("x"), _get(x, "$[1]", "double").alias("y"))
        step = lambda n, x: F.struct(n.alias("step_no"), _get(x, "$.name", "string").alias("name"), _get(x, "$.ms", "double").alias("ms"))
        return F.struct(
            *node,
            _get(m, "$.page_number", "double").cast("int").alias("page_number"),
            _get(m, "$.parent_id", "string").alias("parent_id"),
            _get(m, "$.filename", "string").alias("filename"),
            _get(m, "$.coordinates.system.name", "string").alias("system_name"),
            _get(m, "$.coordinates.system.width", "double").alias("system_width"),
            _get(m, "$.coordinates.system.height", "double").alias("system_height"),
            _get(m, "$.provenance.engine", "string").alias("engine"),
            _get(layout, "$.version", "string").alias("layout_version"),
            _numbered(items(_get(m, "$.languages")), language).alias("languages"),
            _numbered(items(_get(m, "$.coordinates.points")), point).alias("points"),
            _numbered(items(_get(m, "$.provenance.steps")), step).alias("steps"),
        )

    some = lambda v: F.when(_present(v), v)
    region = lambda n, x: _region(n, x, full)
    in_text = F.try_parse_json(_get(m, "$.layout", "string"))
    layout = F.when(_kind(_get(m, "$.layout")) == "s", in_text).otherwise(_get(m, "$.layout"))

    def within(lay: Column) -> Column:
        field = F.coalesce(some(_get(m, "$.regions")), some(_get(lay, "$.regions")))
        return let(field, lambda f: let(_numbered(items(f), region), lambda regions: build(lay, f, regions)))

    return let(layout, within)


def _tree(df: DataFrame, column: str, keys: tuple[str, ...], full: bool = True) -> DataFrame:
    read = let(valid_json(F.col(column)), lambda m: F.when(m.isNotNull(), _element(m, full)))
    return df.select(*keys, read.alias("_e"))


def _explode(df: DataFrame, array: str, name: str, *keep: str) -> DataFrame:
    """Non-null entries of an array. A plain explode would make the optimizer test the array's
    size in a filter below, which evaluates the whole tree expression a second time."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def compile_tree(df: DataFrame, column: str = "metadata", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per readable element: keys, element fields, state and the annotated region tree."""
    return _tree(df, column, keys).select(*keys, "_e.*").where(F.col("state").isNotNull())


def _nodes(e: Column, wanted: list[str]) -> Column:
    """Positions and states of a tree's nodes in the wanted states, in one array."""

    struct = "struct<level:string,state:string,region_no:int,line_no:int,span_no:int>"

    def node(level: str, state: Column, *at: Column) -> Column:
        """An array of the node, or of nothing where its state isn't wanted."""
        asked = [x for x in states(level[:-1]) if x in wanted]
        none = F.array().cast(f"array<{struct}>")
        if not asked:
            return none
        places = [*at, *[F.lit(-1)] * (3 - len(at))]
        one = F.array(F.struct(F.lit(level).alias("level"), state.alias("state"), *[p.alias(n) for p, n in zip(places, ("region_no", "line_no", "span_no"))]))
        return one if len(asked) == len(states(level[:-1])) else F.when(state.isin(*asked), one).otherwise(none)

    def of_line(r: Column, ln: Column) -> Column:
        spans = F.flatten(F.transform(ln["spans"], lambda s: node("spans", s["state"], r["region_no"], ln["line_no"], s["span_no"])))
        return F.concat(node("lines", ln["state"], r["region_no"], ln["line_no"]), spans)

    def of_region(r: Column) -> Column:
        return F.concat(node("regions", r["state"], r["region_no"]), F.flatten(F.transform(r["lines"], lambda ln: of_line(r, ln))))

    return F.concat(node("elements", e["state"]), F.flatten(F.transform(e["regions"], of_region)))


def routed(df: DataFrame, wanted: list[str], column: str = "metadata", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, level, state, region_no, line_no, span_no) of the nodes the automaton sends to the wanted
    states, once each: the keys of these states' subtype tables, from one scan and one parse.

    Only positions and states are shuffled, to bring elements delivered again down to one copy; the
    aggregation combines before the shuffle, and the key is the full path, so a large
    manual spreads over all partitions.
    """
    nodes = let(F.col("_e"), lambda e: F.when(e.isNotNull(), _nodes(e, wanted)))
    rows = _explode(_tree(df, column, keys, full=False).select(*keys, nodes.alias("_n")), "_n", "n", *keys)
    return rows.select(*keys, "n.*").distinct()


def element_rows(df: DataFrame, column: str = "metadata", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per node that ends a path: (keys, region_no, line_no, span_no), -1 where a level is empty.

    It is the union of the keys of the subtype tables of all leaf states: spans of every
    variant, bare lines and bare regions.
    """
    leaves = [s for level in ("span", "line", "region") for s in states(level, leaf=True)]
    return routed(df, leaves, column, keys).select(*keys, "region_no", "line_no", "span_no")


@dataclass(frozen=True)
class FlatTables:
    """Supertype tables and child tables; `subtype` gives the typed table of one structural variant."""

    elements: DataFrame
    regions: DataFrame
    lines: DataFrame
    spans: DataFrame
    refs: DataFrame
    languages: DataFrame
    points: DataFrame
    steps: DataFrame

    #: Columns that only some variants of a level have: those of an optional group, those of a span's kind.
    GROUPS = {
        "element": ("system_name", "system_width", "system_height"),
        "region": ("bbox_x", "bbox_y", "bbox_w", "bbox_h"),
        "line": ("line_id",),
        "span": ("conf", "font_name", "font_size"),
    }
    SPANS = {"span_text": (), "span_plain": ("conf",), "span_refs": ("conf",), "span_font": ("conf", "font_name", "font_size"), "span_font_refs": ("conf", "font_name", "font_size")}

    def subtype(self, state: str) -> DataFrame:
        """The nodes of one state with the columns that state has; a span's refs are in `refs`."""
        level = state.partition("_")[0]
        if state not in states(level):
            raise ValueError(f"no state {state!r}")
        own = self.SPANS[state] if level == "span" else self.GROUPS[level] if state.endswith(OPTIONAL[level][0]) else ()
        source = getattr(self, f"{level}s")
        drop = {"state", *self.GROUPS[level]} - set(own)
        return source.where(F.col("state") == state).select(*[c for c in source.columns if c not in drop])


def flat_tables(df: DataFrame, column: str = "metadata", keys: tuple[str, ...] = KEYS, stage: bool = False) -> FlatTables:
    """Elements, regions, lines, spans and their lists; a child carries the keys of all its ancestors.

    With `stage`, the parsed trees are written once (to the checkpoint folder) and all
    tables read them; without, each table that is used parses for itself.
    """
    tree = _tree(df, column, keys)
    tree = cut_lineage(tree) if stage else tree
    region, line, span = [*keys, "region_no"], [*keys, "region_no", "line_no"], [*keys, "region_no", "line_no", "span_no"]

    def children(parent: DataFrame, array: str, at: list[str], number: str) -> DataFrame:
        return _explode(parent, array, "_x", *at).select(*at, "_x.*").dropDuplicates([*at, number])

    r = _explode(tree, "_e.regions", "r", *keys).select(*keys, "r.*")
    ln = _explode(r, "lines", "l", *region).select(*region, "l.*")
    sp = _explode(ln, "spans", "s", *line).select(*line, "s.*")
    return FlatTables(
        tree.select(*keys, "_e.*").where(F.col("state").isNotNull()).drop("regions", "languages", "points", "steps").dropDuplicates(list(keys)),
        r.drop("lines").dropDuplicates(region),
        ln.drop("spans").dropDuplicates(line),
        sp.drop("refs").dropDuplicates(span),
        children(sp, "refs", span, "ref_no"),
        children(tree, "_e.languages", list(keys), "language_no"),
        children(tree, "_e.points", list(keys), "point_no"),
        children(tree, "_e.steps", list(keys), "step_no"),
    )


def variant_counts(df: DataFrame, column: str = "metadata", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """How many nodes of each level ended in each state."""
    every = [s for level in ("element", "region", "line", "span") for s in states(level)]
    return routed(df, every, column, keys).groupBy("level", "state").agg(F.count("*").alias("n"))
