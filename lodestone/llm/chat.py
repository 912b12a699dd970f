"""Chat formatting with DataFrame functions alone.

A declarative template names each role's markers, whether its texts carry loss, and which
roles may follow which. A finite-state machine walks the turns of a conversation; the
formatted conversation is a list of segments, each with its loss flag, joined by nothing.

Control strings inside texts are escaped reversibly: a backslash is doubled, and ``\\,`` is
put behind the first character of a control string. So each marker found in the output
is one that the template wrote, and :func:`read_back` recovers the turns from the output.

Turns are ordered by turn, role and text, nulls first. A null text or role is empty;
repeated rows are turns of their own; roles outside the template are written with their
name and carry no loss. Rows without conv_id make one conversation. A conversation is one
result row, so its turns meet in one task, as any digest of all of it needs.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``turns``: role, opening and closing marker, loss. ``follows``: roles allowed after a role."""

    begin: str = "<s>"
    turns: tuple = (
        ("system", "[SYS] ", " [/SYS]", False),
        ("user", "[INST] ", " [/INST]", False),
        ("assistant", "[OUT] ", " </s>", True),
        ("tool", "[TOOL] ", " [/TOOL]", False),
    )
    other: tuple = ("[ROLE] ", " [/ROLE]", " [/TURN]")
    follows: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})
    ends: tuple = ("assistant",)

    def controls(self) -> list:
        marks = [self.begin, *self.other, *(m for _, a, b, _ in self.turns for m in (a, b))]
        return sorted({m.strip() for m in marks})


def _quoted(mark: str) -> str:
    return "".join(f"\\{c}" if c in "[]()/|.*+?{}^$\\" else c for c in mark)


def escape(text: Column, template: ChatTemplate) -> Column:
    firsts = "|".join(_quoted(c[0]) + "(?=" + _quoted(c[1:]) + ")" for c in template.controls())
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({firsts})", r"$1\\,")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|,)", "$1")


def _segment(text: Column, loss) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _turn(turn: Column, template: ChatTemplate) -> Column:
    role, body = turn["role"], escape(turn["text"], template)
    opens, shuts, name = template.other
    written = F.array(
        _segment(F.concat(F.lit(opens), escape(role, template), F.lit(shuts)), False),
        _segment(body, False), _segment(F.lit(name), False))
    for known, a, b, loss in template.turns:
        written = F.when(role == known, F.array(
            _segment(F.lit(a), False), _segment(body, loss), _segment(F.lit(b), False))).otherwise(written)
    return written


def _allowed(before: Column, role: Column, template: ChatTemplate) -> Column:
    found = F.lit(False)
    for state, roles in template.follows.items():
        found = found | ((before == state) & role.isin(*roles))
    return found


def format_chats(chats: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: conv_id, valid, first_bad (turn, from 0), segments, formatted."""
    template = template or ChatTemplate()
    rows = chats.select(
        "conv_id", F.struct("turn", "role", "text").alias("turn"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    empty = F.lit("")
    turns = F.transform("turns", lambda t: F.struct(
        F.coalesce(t["role"], empty).alias("role"), F.coalesce(t["text"], empty).alias("text")))
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("n"), F.lit(-1).alias("bad"))
    walked = F.aggregate("turns", start, lambda at, turn: F.struct(
        turn["role"].alias("state"), (at["n"] + 1).alias("n"),
        F.when((at["bad"] < 0) & ~_allowed(at["state"], turn["role"], template), at["n"])
        .otherwise(at["bad"]).alias("bad")))
    bad = F.when(F.col("end.bad") >= 0, F.col("end.bad")).when(
        ~F.col("end.state").isin(*template.ends), F.col("end.n"))
    return (
        talks.withColumn("turns", turns).withColumn("end", walked)
        .withColumn("segments", F.concat(
            F.array(_segment(F.lit(template.begin), False)),
            F.flatten(F.transform("turns", lambda turn: _turn(turn, template)))))
        .select("conv_id", bad.isNull().alias("valid"), bad.alias("first_bad"), "segments",
                F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    )


def read_back(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The turns (role, text) that a formatted conversation holds, as an array."""
    template = template or ChatTemplate()
    opens, named, shuts = template.other
    starts = "|".join(_quoted(m) for m in [opens, *(a for _, a, _, _ in template.turns)])
    ends = "|".join(_quoted(m) for m in [shuts, *(b for _, _, b, _ in template.turns)])
    pattern = F.lit(f"(?s)({starts})(.*?)(?:{ends})")
    marks, bodies = (F.regexp_extract_all(formatted, pattern, F.lit(i)) for i in (1, 2))

    def turn(mark, body):
        role = unescape(F.substring_index(body, named, 1))
        text = F.when(mark == opens, _after(body, named)).otherwise(body)
        for known, a, _, _ in template.turns:
            role = F.when(mark == a, F.lit(known)).otherwise(role)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.zip_with(marks, bodies, turn)


def _after(body: Column, mark: str) -> Column:
    """What follows the first ``mark``."""
    return F.substr(body, F.instr(body, mark) + len(mark))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def with_probe(chats: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are made of control strings."""
    spark: SparkSession = chats.sparkSession
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"),
                 said.alias("text")) for i, role in enumerate(("user", "assistant"))])).alias("row"))
    kept = chats.select("conv_id", "turn", "role", "text")
    return kept.unionByName(probe.select("row.*"))


def chat_digests(chats: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Digests read back from the formatted conversations."""
    made = format_chats(with_probe(chats), template)
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        made.withColumn("turns", read_back(F.col("formatted"), template))
        .withColumn("loss", loss_text(F.col("segments")))
        .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                F.length("formatted").cast("long").alias("formatted_chars"), "valid")
    )
