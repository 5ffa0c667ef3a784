r"""Chat formatting with a grammar round trip, in SQL functions only.

    conversation := turn*
    turn         := "[INST]" body "[/INST]" | "<s>" body "</s>"
    body         := role newline text

The second form is an assistant's turn, whose text is what the loss covers. ``[INST!]``
and ``<s!>`` open a turn whose body is escaped: ``\`` is written ``\0``, ``[`` ``\1``,
``<`` ``\2`` and a line end inside a role ``\3``, so no control string is left in it.

Each turn is rendered as it is and parsed again; if the parser does not give the turn
back, its body is escaped. The whole conversation is then rendered and parsed, and if it
differs from its source all its turns are escaped. A difference that is still left ends
the job.

Defined results: a null role or text is empty; turns are in order of ``turn`` (null
first), then role and text, so repeated rows are repeated turns; a null ``conv_id`` is a
conversation of its own; an empty table gives no rows; other columns are passed over. A
conversation is one string, so its turns meet in one row; parsing and escaping of turns
come before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTROL = r"\[INST!?\]|\[/INST\]|<s!?>|</s>"


def _escape(text: Column, role: bool = False) -> Column:
    for sign, written in (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"), *([("\n", "\\3")] if role else [])):
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def _unescape(text: Column) -> Column:
    for sign, written in (("\n", "\\3"), ("<", "\\2"), ("[", "\\1"), ("\\", "\\0")):
        text = F.replace(text, F.lit(written), F.lit(sign))
    return text


def _rendered(role: Column, text: Column, escaped: Column) -> Column:
    assistant = role == "assistant"
    mark = F.when(escaped, "!").otherwise("")
    return F.concat(
        F.when(assistant, "<s").otherwise("[INST"),
        mark,
        F.when(assistant, ">").otherwise("]"),
        F.when(escaped, _escape(role, role=True)).otherwise(role),
        F.lit("\n"),
        F.when(escaped, _escape(text)).otherwise(text),
        F.when(assistant, "</s>").otherwise("[/INST]"),
    )


def _parsed(controls: Column, parts: Column) -> Column:
    """Turns that the control strings and the text between them make, null if they are no
    conversation."""

    def turn(i: Column) -> Column:
        opening, body, closing = F.get(controls, 2 * i), F.get(parts, 2 * i + 1), F.get(controls, 2 * i + 1)
        escaped = F.substring(opening, -2, 1) == "!"
        assistant = F.substring(opening, 1, 1) == "<"
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        fits = (closing == F.when(assistant, "</s>").otherwise("[/INST]")) & opening.isin("[INST]", "[INST!]", "<s>", "<s!>")
        return F.struct(
            F.when(escaped, _unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, _unescape(text)).otherwise(text).alias("text"),
            assistant.alias("loss"),
            (fits & body.contains("\n") & (F.get(parts, 2 * i) == "")).alias("fits"),
        )

    n = F.floor(F.size(controls) / 2).cast("int")
    turns = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), turn)).otherwise(F.array())
    whole = (F.size(controls) == 2 * n) & (F.element_at(parts, -1) == "") & F.forall(turns, lambda t: t.fits)
    return F.when(whole, turns)


def parse(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the turns (role, text, loss, fits) that a formatted text holds."""
    controls, parts = F.regexp_extract_all(column, F.lit(_CONTROL), F.lit(0)), F.split(column, _CONTROL, -1)
    return (
        df.withColumns({f"{name}_controls": controls, f"{name}_parts": parts})
        .withColumn(name, _parsed(F.col(f"{name}_controls"), F.col(f"{name}_parts")))
        .drop(f"{name}_controls", f"{name}_parts")
    )


def _same(parsed: str, turns: str) -> Column:
    bare = lambda c: F.transform(c, lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    return F.coalesce(bare(parsed) == bare(turns), F.lit(False))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``parsed``, the turns as read back from it."""
    turns = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    alone = turns.withColumn("plain", _rendered(F.col("role"), F.col("text"), F.lit(False)))
    alone = parse(alone, "plain", "read").withColumn("source", F.array(F.struct("role", "text")))
    alone = alone.select("conv_id", F.struct("turn", "role", "text", (~_same("read", "source")).alias("escaped")).alias("t"))
    whole = alone.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    render = lambda escaped: F.array_join(
        F.transform("turns", lambda t: _rendered(t.role, t.text, t.escaped | F.lit(escaped))), ""
    )
    whole = parse(whole.withColumn("first", render(False)), "first", "parsed")
    whole = whole.withColumn("formatted", F.when(_same("parsed", "turns"), F.col("first")).otherwise(render(True)))
    whole = parse(whole.select("conv_id", "turns", "formatted"), "formatted", "parsed")
    checked = F.when(_same("parsed", "turns"), F.col("parsed")).otherwise(
        F.raise_error(F.lit("a conversation does not survive its format"))
    )
    return whole.select("conv_id", "formatted", checked.alias("parsed"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the turns and of the text under the loss."""
    turns = F.array_join(F.transform("parsed", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t.loss), lambda t: t.text), "")
    return formatted.withColumns({"turns": turns, "loss": loss}).select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), rendered AS (
    SELECT *, role = 'assistant' AS loss,
        contains(role, chr(10)) OR regexp_matches(role || chr(10) || text, '\[INST!?\]|\[/INST\]|<s!?>|</s>') AS escaped
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (loss), '')) AS loss_sha256,
    sum(length(role) + 1 + length(text) + CASE WHEN loss THEN 7 ELSE 13 END
        + CASE WHEN escaped THEN 1 + length(regexp_replace(role || text, '[^\\\[<]', '', 'g'))
            + length(role) - length(replace(role, chr(10), '')) ELSE 0 END)::BIGINT AS formatted_chars
FROM rendered GROUP BY conv_id
"""
