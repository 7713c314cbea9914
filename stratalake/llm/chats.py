"""Chat formatting: records of many layouts become canonical turns, and these one marked-up text with a loss mask.

Everything is built-in DataFrame functions; records are of type VARIANT, so that one column may hold any mix of
layouts. `from_json_text` and `from_columns` make such a column.

- **Fingerprint.** A record's nested field paths (`messages[].content`) are read off its own
  schema. Those that some layout knows are sorted and hashed; others, like a source or a date, don't matter.
- **Layout.** A `Layout` declares where turns lie: fields that are turns by themselves, or an
  array of turns. Its hashes are computed when the query is planned, one per set of fields that
  may be lacking, and each record takes the layout with its hash. A record without one
  stops the job, or is left out with `strict=False`; `unknown_layouts` counts those by their paths.
- **Turns.** One row per turn: id, position, role, text. A layout may also be one turn per record, so
  a table of turns needs no grouping beforehand. All turns of an id are one conversation, in the
  order of position, role, text.
- **Template.** `<|im_start|>role`, line break, text, `<|im_end|>`, line break for each turn. Inside texts, every `<`
  with any number of backslashes and a `|` behind it takes one backslash more, so no control string
  can stand in an escaped text, all others stay as they are, and `unescape` gives the text back. In roles,
  `%`, line breaks and `|` are spelled `%25`, `%0A`, `%7C`.
- **Loss mask.** Byte ranges of the marked-up text, one per assistant turn, of its text alone.

One shuffle, by id. A conversation is one row of the result and so must fit a task; hot ids
are as large as their result, nothing else is gathered.

Defined results: a null text is empty; a null role is an empty one; a null id is an id; a null position comes first; turns
with equal position are ordered by role and text, and repeated ones all stay; a record with an empty or null array
of turns gives a conversation without turns and an empty text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
TURN = "struct<position: bigint, role: string, text: string>"
TOKENS = r"(`(?:[^`]|``)*`: |[A-Za-z0-9_]+: |OBJECT<|ARRAY<|>|[A-Z_]+(?:\([0-9, ]*\))?)"


@dataclass(frozen=True)
class Turn:
    """A turn from fields of the record; several texts are joined by an empty line.

    `role` is a role, or the path of one if `role_path` is set. Fields in `optional` may be lacking; without any of its
    texts, an optional turn doesn't take place.
    """

    role: str
    texts: tuple[str, ...]
    role_path: bool = False
    optional: frozenset[str] = frozenset()

    def paths(self) -> set[str]:
        return {*self.texts, *([self.role] if self.role_path else [])}

    def column(self, record: Column, position: Column, roles: dict[str, str]) -> Column:
        role = renamed(F.variant_get(record, f"$.{self.role}", "string"), roles) if self.role_path else F.lit(self.role)
        given = [F.variant_get(record, f"$.{p}", "string") for p in self.texts]
        text = F.array_join(F.filter(F.array(*given), lambda t: t.isNotNull() & (t != "")), "\n\n")
        turn = F.struct(position.cast("bigint").alias("position"), F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))
        return F.when(F.coalesce(*given).isNotNull(), turn) if set(self.texts) <= self.optional else turn


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record lie: `turns` in its fields, or objects of the array `each` with a role and a text."""

    name: str
    turns: tuple[Turn, ...] = ()
    each: tuple[str, str, str] | None = None
    position: str | None = None
    roles: dict[str, str] = field(default_factory=dict)

    def path_sets(self) -> list[frozenset[str]]:
        """The sets of paths that records of this layout may have."""
        if self.each:
            array, role, text = self.each
            return [frozenset(s) for s in ({f"{array}[].{role}", f"{array}[].{text}"}, {f"{array}[]"}, {array})]
        optional = sorted(set().union(*(t.optional for t in self.turns)))
        needed = set().union(*(t.paths() for t in self.turns), [self.position] if self.position else []) - set(optional)
        return [frozenset(needed.union(some)) for n in range(len(optional) + 1) for some in combinations(optional, n)]

    def column(self, record: Column) -> Column:
        if self.each:
            array, role, text = self.each
            given = F.variant_get(record, f"$.{array}", f"array<struct<`{role}`: string, `{text}`: string>>")
            return F.transform(F.coalesce(given, F.array().cast(f"array<struct<`{role}`: string, `{text}`: string>>")), lambda x, i: F.struct(
                i.cast("bigint").alias("position"), F.coalesce(renamed(x[role], self.roles), F.lit("")).alias("role"),
                F.coalesce(x[text], F.lit("")).alias("text"),
            ))
        place = [F.variant_get(record, f"$.{self.position}", "bigint")] if self.position else map(F.lit, range(len(self.turns)))
        return F.filter(F.array(*[t.column(record, p, self.roles) for t, p in zip(self.turns, place, strict=True)]), lambda t: t.isNotNull())


LAYOUTS = (
    Layout("rows", (Turn("role", ("text",), role_path=True),), position="turn"),
    Layout("messages", each=("messages", "role", "content")),
    Layout("speakers", each=("conversations", "from", "value"), roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt and response", (Turn("user", ("prompt",)), Turn("assistant", ("response",)))),
    Layout("prompt and completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Layout("instruction", (
        Turn("system", ("system",), optional=frozenset({"system"})),
        Turn("user", ("instruction", "input"), optional=frozenset({"input"})),
        Turn("assistant", ("output",)),
    )),
)


def renamed(role: Column, roles: dict[str, str]) -> Column:
    return reduce(lambda other, r: F.when(role == r[0], r[1]).otherwise(other), roles.items(), role)


def from_json_text(text: Column) -> Column:
    return F.parse_json(text)


def from_columns(*columns: str | Column) -> Column:
    """A record of some columns of a table; their names are its fields."""
    return F.call_function("to_variant_object", F.struct(*columns))


def field_paths(record: Column) -> Column:
    """The sorted paths of all leaves of a record; `[]` stands for the elements of an array."""
    strings = F.array().cast("array<string>")
    start = F.struct(strings.alias("above"), F.lit("").alias("here"), strings.alias("found"))

    def step(s: Column, token: Column) -> Column:
        opens = token.isin("OBJECT<", "ARRAY<")
        name = F.regexp_replace(token, ": $", "")
        upper = F.element_at(s["above"], F.lit(-1))
        above = F.when(opens, F.array_append(s["above"], s["here"]))
        above = above.when(token == ">", F.slice(s["above"], 1, F.size(s["above"]) - 1)).otherwise(s["above"])
        here = F.when(token == "ARRAY<", F.concat(s["here"], F.lit("[]")))
        here = here.when(token.endswith(": "), F.when(upper == "", name).otherwise(F.concat(upper, F.lit("."), name))).otherwise(s["here"])
        leaf = ~opens & (token != ">") & ~token.endswith(": ")
        found = F.when(leaf, F.array_append(s["found"], s["here"])).otherwise(s["found"])
        return F.struct(above.alias("above"), here.alias("here"), found.alias("found"))

    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(TOKENS), 1)
    return F.array_sort(F.array_distinct(F.aggregate(tokens, start, step, lambda s: s["found"])))


def path_hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def known_paths(layouts: Sequence[Layout]) -> list[str]:
    return sorted(set().union(*(s for layout in layouts for s in layout.path_sets())))


def fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """A hash of the paths of a record that any of the layouts knows."""
    known = F.array(*map(F.lit, known_paths(layouts)))
    return path_hash(F.array_intersect(field_paths(record), known))


def by_layout(marked: Column, layouts: Sequence[Layout], value, otherwise: Column) -> Column:
    """What `value` gives for the layout whose hash the record has."""
    seen: dict[frozenset[str], str] = {}
    out = F
    for layout in layouts:
        sets = layout.path_sets()
        for s in sets:
            if s in seen:
                raise ValueError(f"layouts {seen[s]!r} and {layout.name!r} have the same paths")
            seen[s] = layout.name
        hashes = [path_hash(F.array(*map(F.lit, sorted(s)))) for s in sets]
        out = out.when(marked.isin(*hashes), value(layout))
    return out.otherwise(otherwise)


def with_layout(records: DataFrame, record: str, layouts: Sequence[Layout]) -> DataFrame:
    marked = records.withColumn("fingerprint", fingerprint(F.col(record), layouts))
    return marked.withColumn("layout", by_layout(F.col("fingerprint"), layouts, lambda x: F.lit(x.name), F.lit(None).cast("string")))


def unknown_layouts(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(paths, n): the nested field paths of records that no layout fits, and how many have each set."""
    marked = with_layout(records.select(F.col(record).alias("__record")), "__record", layouts).filter(F.col("layout").isNull())
    return marked.groupBy(field_paths(F.col("__record")).alias("paths")).agg(F.count(F.lit(1)).alias("n"))


def canonical_turns(
    records: DataFrame, record: str = "record", id_path: str = "conv_id", id_type: str = "bigint",
    layouts: Sequence[Layout] = LAYOUTS, strict: bool = True,
) -> DataFrame:
    """(id, layout, position, role, text) of each turn; a record without turns gives one row without a role."""
    marked = with_layout(records.select(F.col(record).alias("__record")), "__record", layouts)
    none = F.array().cast(f"array<{TURN}>")
    lacking = F.raise_error(F.concat(F.lit("no layout for a record with the paths "), F.array_join(field_paths(F.col("__record")), ", ")))
    turns = by_layout(F.col("fingerprint"), layouts, lambda x: x.column(F.col("__record")), lacking.cast(f"array<{TURN}>") if strict else none)
    if not strict:
        marked = marked.filter(F.col("layout").isNotNull())
    given = marked.select(F.variant_get("__record", f"$.{id_path}", id_type).alias("id"), "layout", F.explode_outer(turns).alias("turn"))
    return given.select("id", "layout", "turn.position", "turn.role", "turn.text")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("|"), F.lit("%7C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(id, formatted, loss): the marked-up text of each conversation, and the byte ranges that are learned."""
    order = Window.partitionBy("id").orderBy("position", "role", "text")
    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit("\n"))
    written = turns.select(
        "id", "role", F.row_number().over(order).alias("k"), F.col("role").isNotNull().alias("real"), head.alias("head"),
        escape(F.col("text")).alias("body"), "position", "text",
    )
    tail = f"{END}\n"
    size = F.octet_length("head") + F.octet_length("body") + len(tail)
    before = F.coalesce(F.sum(size.cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    placed = written.select("id", F.struct(
        "k", F.concat("head", "body", F.lit(tail)).alias("piece"), (F.col("role") == LEARNED).alias("learned"),
        (before + F.octet_length("head")).alias("start"), F.octet_length("body").cast("bigint").alias("length"), "real",
    ).alias("turn"))
    parts = F.array_sort(F.filter(F.collect_list("turn"), lambda t: t["real"]))
    whole = placed.groupBy("id").agg(parts.alias("parts"))
    return whole.select(
        "id", F.array_join(F.col("parts.piece"), "").alias("formatted"),
        F.transform(F.filter("parts", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a marked-up text: role and text of each."""
    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - len(END) - 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, BEGIN.replace("|", r"\|"))
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), "")


def digests(conversations: DataFrame, name: str = "conv_id") -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from marked-up texts."""
    back = conversations.select(
        F.col("id").alias(name), F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        name, F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
