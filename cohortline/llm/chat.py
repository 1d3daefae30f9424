"""Chat formatting by schema fingerprints (operator 10), in DataFrame functions only.

A record's nested field paths, without its values and scalar types, are hashed; the hash selects a declarative
mapping that turns its layout (prompts, instructions, message lists, single turns) into canonical turns. The template
marks every turn; ``&``, ``<`` and ``[`` in texts and roles are written as entities, so no control string can be
imitated and reading back is exact. The loss mask is a list of byte spans of the formatted UTF-8 text: the assistant's texts.

Null roles and texts are empty. A record of an unknown layout, one that is no JSON or one whose JSON is over Spark's
variant limit (128 MiB) keeps its row, with a null layout and no turns. Equal turn numbers are ordered by role, then text; null turns come
first. Repeated rows are repeated turns. A null conversation id is a conversation of its own. An empty table gives no rows.
Columns other than the named ones are not read. A conversation is one text, so its turns do meet in one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN = "<|turn|>"
END = "<|end|>\n"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"

#: The escaped characters, the escape mark first. A role's line feed is escaped as well.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: fixed roles with their fields, or a list of messages.

    ``turns`` has (role, fields); several fields are joined by a blank line, empty ones left out. A role ``$name`` is
    read from that field. ``messages`` has (list, role field, text field); ``roles`` renames roles.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    messages: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> str:
        """The field paths of its records, as ``field_paths`` writes them."""
        if self.messages:
            name, role, text = self.messages
            inner = ", ".join(f"{f}: *" for f in sorted((role, text)))
            return f"OBJECT<{name}: ARRAY<OBJECT<{inner}>>>"
        names = {f for _, fields in self.turns for f in fields} | {r[1:] for r, _ in self.turns if r[:1] == "$"}
        return f"OBJECT<{', '.join(f'{f}: *' for f in sorted(names))}>"

    def of(self, record: Column) -> Column:
        """Its turns from a variant."""

        def text(name: str) -> Column:
            return F.coalesce(F.variant_get(record, f"$.{name}", "string"), F.lit(""))

        if self.messages:
            name, role_field, text_field = self.messages
            kind = f"array<struct<`{role_field}`:string,`{text_field}`:string>>"
            listed = F.variant_get(record, f"$.{name}", kind)
            return F.transform(
                listed,
                lambda m: F.struct(
                    self.role(F.coalesce(m[role_field], F.lit(""))).alias("role"),
                    F.coalesce(m[text_field], F.lit("")).alias("text"),
                ),
            )
        made = []
        for role, fields in self.turns:
            named = self.role(text(role[1:])) if role[:1] == "$" else F.lit(role)
            if len(fields) == 1:
                said = text(fields[0])
            else:
                said = F.concat_ws("\n\n", *[F.nullif(text(f), F.lit("")) for f in fields])
            made.append(F.struct(named.alias("role"), said.alias("text")))
        return F.array(*made)

    def role(self, name: Column) -> Column:
        out = name
        for old, new in self.roles.items():
            out = F.when(name == old, new).otherwise(out)
        return out


#: Layouts in common use.
LAYOUTS = (
    Mapping("turn", (("$role", ("text",)),)),
    Mapping("prompt_response", (("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Mapping("prompt_completion", (("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Mapping("question_answer", (("user", ("question",)), (ASSISTANT, ("answer",)))),
    Mapping("instruction_output", (("user", ("instruction",)), (ASSISTANT, ("output",)))),
    Mapping("instruction_input_output", (("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Mapping("system_prompt_response", (("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Mapping("messages", messages=("messages", "role", "content")),
    Mapping("conversations", messages=("conversations", "from", "value"), roles={"human": "user", "gpt": ASSISTANT}),
)


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant; every scalar type is written ``*``."""
    return F.regexp_replace(
        F.schema_of_variant(record), r"(?<=(?:^|: |<))(?!OBJECT<|ARRAY<)[A-Z_]+(?:\([0-9, ]*\))?(?=$|,|>)", "*"
    )


def canonical_turns(df: DataFrame, record_col: str = "record", layouts: tuple[Mapping, ...] = LAYOUTS) -> DataFrame:
    """The rows with ``schema_hash``, the chosen ``layout`` and the canonical ``turns`` of a JSON record."""
    parsed = df.withColumn("_record", F.try_parse_json(record_col))
    hashed = parsed.withColumn("schema_hash", F.xxhash64(field_paths(F.col("_record"))))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for m in reversed(layouts):
        chosen = F.col("schema_hash") == F.xxhash64(F.lit(m.paths()))
        layout = F.when(chosen, m.name).otherwise(layout)
        turns = F.when(chosen, m.of(F.col("_record")).cast(TURNS)).otherwise(turns)
    return hashed.withColumns({"layout": layout, "turns": turns}).drop("_record")


def escaped(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for char, entity in table:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescaped(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for char, entity in reversed(table):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def formatted(turns: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans`` (start and length in bytes) and ``n_unmapped``.

    ``turns`` has one row per turn with ``role`` and ``text``; a row without a role is no turn, keeps its conversation, and counts as
    unmapped if its column ``unmapped`` says so. One shuffle, by conversation.
    """
    if "unmapped" not in turns.columns:
        turns = turns.withColumn("unmapped", F.lit(False))
    opening = F.concat(F.lit(TURN), escaped(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    written = turns.select(
        id_col, *[c for c in order if c not in ("role", "text")], "role", "text", "unmapped",
        opening.alias("opening"), escaped(F.col("text")).alias("said"),
    )
    inside = Window.partitionBy(id_col).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("opening") + F.octet_length("said") + len(END)
    turn = F.struct(
        F.row_number().over(inside).alias("n"),
        F.concat("opening", "said", F.lit(END)).alias("turn"),
        (F.col("role") == ASSISTANT).alias("counts"),
        (F.coalesce(F.sum(size).over(earlier), F.lit(0)) + F.octet_length("opening")).alias("start"),
        F.octet_length("said").cast("bigint").alias("length"),
    )
    placed = written.select(id_col, "unmapped", F.when(F.col("role").isNotNull(), turn).alias("t"))
    # A list leaves nulls out.
    joined = placed.groupBy(id_col).agg(
        F.array_sort(F.collect_list("t")).alias("ts"), F.count_if("unmapped").alias("n_unmapped")
    )
    return joined.select(
        id_col,
        "n_unmapped",
        F.array_join(F.transform("ts", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(
            F.filter("ts", lambda t: t["counts"]),
            lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
        ).alias("loss_spans"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation, unescaped."""
    parts = F.split(text, TURN.replace("|", r"\|"), -1)
    bodies = F.filter(F.transform(parts, lambda p: F.substr(p, F.lit(1), F.length(p) - len(END))), lambda p, i: i > 0)
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescaped(F.substring_index(b, "\n", 1), ROLE_ESCAPES).alias("role"),
            unescaped(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text"),
        ),
    )


def read_loss(data: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask; ``data`` is the formatted text as UTF-8 bytes."""
    masked = F.transform(
        spans, lambda s: F.decode(F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")
    )
    return unescaped(F.array_join(masked, ""))


def format_records(
    df: DataFrame, id_col: str = "conv_id", order_col: str = "turn", record_col: str = "record"
) -> DataFrame:
    """Conversations from JSON records of any known layout; records of one id follow each other by ``order_col``.

    A record of an unknown layout, or that is no JSON, adds nothing to its conversation and is counted in ``n_unmapped``; a
    conversation of such records, or of empty ones, stays with an empty text.
    """
    plain = df.select(F.col(id_col).alias("conv_id"), F.col(order_col).alias("turn"), F.col(record_col).alias("record"))
    unmapped = F.col("layout").isNull().alias("unmapped")
    turns = canonical_turns(plain).select("conv_id", "turn", unmapped, F.posexplode_outer("turns").alias("place", "t"))
    named = turns.select("conv_id", "turn", "place", "unmapped", F.col("t.role").alias("role"), F.col("t.text").alias("text"))
    return formatted(named, "conv_id", ["turn", "place", "role", "text"])


def turn_records(df: DataFrame, role_col: str = "role", text_col: str = "text") -> Column:
    """A table's row as a JSON record of the single-turn layout."""
    return F.to_json(
        F.struct(F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")),
        {"ignoreNullFields": "false"},
    )
