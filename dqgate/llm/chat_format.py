r"""Chat formatting by a grammar round trip.

    conversation := turn*
    turn         := "### " role ":" mark " " body "</turn>\n"
    mark         := "" | "\\"          body as it is | body escaped

A turn is rendered with its body as it is and parsed back; if that doesn't give the same
role and text, its body is escaped: `\` before `\`, before the `/` of `</turn>` and
between `##`. An escaped body holds neither control string, and dropping the escape
gives the text back, so no turn conflicts any more. Roles are always escaped.

The loss mask is a list of byte ranges of the output, one per assistant turn.

Defined results: turns are ordered by turn (null first), then role, then text; repeated
rows are repeated turns. A null text or role counts as empty. Rows without `conv_id` form
a conversation of their own. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqgate.llm.common import let

HEAD, END = "### ", "</turn>\n"
_MARK = "\\"


def _escaped_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\:<#\n])", r"\\$1")


def _escaped_body(text: Column) -> Column:
    return F.replace(
        F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("</turn>"), F.lit("<\\/turn>")),
        F.lit("##"),
        F.lit("#\\#"),
    )


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render_turn(role: Column, text: Column, escape: bool) -> Column:
    mark, body = (_MARK, _escaped_body(text)) if escape else ("", text)
    return F.concat(F.lit(HEAD), _escaped_role(role), F.lit(f":{mark} "), body, F.lit(END))


_TURN = r"(?s)^### ((?:[^\\:]|\\.)*):(\\?) (.*)$"


def parse(formatted: Column) -> Column:
    """The turns of an output, as an array of (role, text)."""

    def turn(piece: Column) -> Column:
        mark, body = F.regexp_extract(piece, _TURN, 2), F.regexp_extract(piece, _TURN, 3)
        return F.struct(
            _unescaped(F.regexp_extract(piece, _TURN, 1)).alias("role"),
            F.when(mark == "", body).otherwise(_unescaped(body)).alias("text"),
        )

    pieces = F.split(formatted, "</turn>\n")
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def _conflicts(rendered: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn isn't read back as exactly this turn."""
    only = lambda t: (F.size(t) == 1) & (F.get(t, 0)["role"] == role) & (F.get(t, 0)["text"] == text)
    # The parser takes any text between head and end, so a second head inside a body
    # does no harm to it; it would to readers that look for heads.
    stray = F.contains(text, F.lit("###"))
    return ~F.coalesce(let(parse(rendered), only), F.lit(False)) | stray


def format_turns(rows: DataFrame) -> DataFrame:
    """`(conv_id, role, text, rendered, escaped, start, n_bytes)` per turn, in bytes of the output."""
    turns = rows.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    plain, safe = render_turn(role, text, False), render_turn(role, text, True)
    drawn = turns.withColumn("escaped", _conflicts(plain, role, text)).withColumn(
        "rendered", F.when(F.col("escaped"), safe).otherwise(plain)
    )
    return drawn


def format_conversations(rows: DataFrame) -> DataFrame:
    """`(conv_id, formatted, mask)`: mask holds `(start, length)` in bytes, from 0, of assistant bodies."""
    drawn = format_turns(rows)
    order = ["turn", "role", "text"]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.select(
        "conv_id",
        F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).alias("pos"),
        F.coalesce(F.sum(F.octet_length("rendered")).over(before), F.lit(0)).alias("at"),
        "rendered",
        (F.col("role") == "assistant").alias("learnt"),
        # Head, role, colon, mark and blank come before the body.
        (F.octet_length(F.concat(F.lit(HEAD), _escaped_role(F.col("role")))) + 2 + F.col("escaped").cast("int")).alias("lead"),
    )
    span = F.struct(
        (F.col("at") + F.col("lead")).alias("start"),
        (F.octet_length("rendered") - F.col("lead") - F.lit(len(END))).cast("long").alias("length"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "rendered"))).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("learnt"), span))).alias("mask"),
    )
    return gathered.select("conv_id", F.array_join("turns.rendered", "").alias("formatted"), "mask")


def learnt_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, read from the output."""

    def text(raw: Column, span: Column) -> Column:
        body = F.decode(F.substring(raw, (span["start"] + 1).cast("int"), span["length"].cast("int")), "UTF-8")
        marked = F.substring(raw, (span["start"] - 1).cast("int"), F.lit(1)) == F.lit(_MARK).cast("binary")
        return F.when(marked, _unescaped(body)).otherwise(body)

    return let(F.encode(formatted, "UTF-8"), lambda raw: F.transform(mask, lambda span: text(raw, span)))
