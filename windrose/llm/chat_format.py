"""Chat formatting: a role state machine and a declarative template, in Spark expressions.

`formatted_chats` turns conversations (one row per turn) into one row per conversation with text
segments, a loss flag for each segment, the joined text, and the verdict of the state machine.
`parsed_turns` reads the turns back from the joined text alone.

Defined results: a null text or role counts as empty; turns are ordered by `turn` (null first), ties
by role and text, and repeated rows are repeated turns; rows with a null `conv_id` form one
conversation; an empty table gives no rows; columns other than the four named ones are ignored.
Conversations that the machine refuses are formatted all the same and marked `valid = false`.
A conversation is one output row, so a task holds one conversation's whole text.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import table


@dataclass(frozen=True)
class Template:
    """What stands around a turn's text, and which roles are learned.

    `openers` are the marks before the texts of known roles; any other role is named in
    `other_opener`. No text contains `mark` or `closer` unescaped, and every opener starts with
    `mark`, so that the joined text can be cut at the closers again.
    """

    openers: dict[str, str] = field(
        default_factory=lambda: {
            "system": "### System: ",
            "user": "### User: ",
            "assistant": "### Assistant: ",
        }
    )
    other_opener: tuple[str, str] = ("### Role ", ": ")
    mark: str = "### "
    closer: str = " </turn>\n"
    control: str = "</turn>"
    learned: tuple[str, ...] = ("assistant",)


#: Allowed steps of the machine: from a state, a role leads to the state of that name.
TRANSITIONS = {
    "start": ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
FINAL = ("user", "assistant")
_REFUSED = "refused"

CHATS = Template()


def _broken(text: str) -> str:
    """The escaped form of a control string: a backslash after its first character."""
    return f"{text[0]}\\{text[1:]}"


def escaped(text: Column, *controls: str) -> Column:
    """Doubles backslashes, then breaks every control string with one; see `unescaped`."""
    result = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in controls:
        result = F.replace(result, F.lit(control), F.lit(_broken(control)))
    return result


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_state(roles: Column) -> Column:
    """Runs the machine over an array of roles; a step that is not allowed ends in `refused`."""
    steps = F.array(
        *[F.lit(f"{state}\n{role}") for state, roles_ in TRANSITIONS.items() for role in roles_]
    )
    return F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.when(
            F.array_contains(steps, F.concat_ws("\n", state, role)), role
        ).otherwise(F.lit(_REFUSED)),
    )


def _opener(role: Column, template: Template) -> Column:
    before, after = template.other_opener
    result = F.concat(F.lit(before), escaped(role, template.mark, template.control, after), F.lit(after))
    for name, opener in template.openers.items():
        result = F.when(role == name, F.lit(opener)).otherwise(result)
    return result


def _segments(turn: Column, template: Template) -> Column:
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        segment(_opener(turn["role"], template), F.lit(False)),
        segment(
            escaped(turn["text"], template.mark, template.control),
            turn["role"].isin(*template.learned),
        ),
        segment(F.lit(template.closer), F.lit(False)),
    )


def formatted_chats(turns: DataFrame, template: Template = CHATS) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted string, state string, valid boolean."""
    empty = F.lit("")
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    state = final_state(F.transform("turns", lambda t: t["role"]))
    return (
        chats.select(
            "conv_id",
            F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
            state.alias("state"),
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("valid", F.col("state").isin(*FINAL))
    )


def parsed_turns(formatted: Column, template: Template = CHATS) -> Column:
    """array<struct<role, text>> from a joined text."""
    before, after = template.other_opener
    # Each piece of the split but the last is an opener and an escaped text.
    pieces = F.split(formatted, template.closer, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        named = F.substring_index(F.substr(piece, F.lit(len(before) + 1)), after, 1)
        role = unescaped(named)
        text = F.substr(piece, F.lit(len(before) + len(after) + 1) + F.length(named))
        for name, opener in template.openers.items():
            known = piece.startswith(opener)
            role = F.when(known, F.lit(name)).otherwise(role)
            text = F.when(known, F.substr(piece, F.lit(len(opener) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), ""
    )


def _planted(spark: SparkSession) -> DataFrame:
    """The conversation -7, whose texts hold control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = formatted_chats(conversations.unionByName(_planted(spark)))
    turns = parsed_turns(F.col("formatted"))
    script = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = loss_text(F.col("segments"))
    return chats.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(script, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


QUERIES = {"op8_chat_formatting": op8_chat_formatting}

# The texts are taken from the rows; only the lengths follow the template.
ORACLE_SQL = {
    "op8_chat_formatting": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                     (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), measured AS (
    SELECT *,
        CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 END
        + length(text) + length(text) - length(replace(text, '\', ''))
        + (length(text) - length(replace(text, '### ', ''))) // 4
        + (length(text) - length(replace(text, '</turn>', ''))) // 7 + 9 AS chars
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS script,
        coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learned,
        string_agg(role, ' ' ORDER BY turn, role, text) AS roles,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM measured GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(script) AS turns_sha256, length(learned) AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars,
    regexp_full_match(roles, '(system )?user( assistant user)*( assistant)?') AS valid
FROM joined
"""
}
