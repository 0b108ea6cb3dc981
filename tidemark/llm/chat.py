"""Chat formatting in Spark expressions only.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per message; adjacent turns of
one role are one message whose texts are joined by ``<|im_sep|>``, so that the
turns can be read back.  Control strings inside a text get one backslash after
their first character (and one more if some are there already), which
``unescape`` takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: What may not appear in a text as it is: this template's marks and other common ones.
_TAIL = r"(/?s>|/?INST\]|/?SYS>>|\|(?:im_start|im_end|im_sep|endoftext)\|>)"
_PLAIN = r"([<\[])(\\*)" + _TAIL
_ESCAPED = r"([<\[])\\(\\*)" + _TAIL


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    """Roles stand on one line, before the text: line breaks are written ``%0A``."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation from rows ``(conv_id, turn, role, text)``.

    Returns ``conv_id, messages, segments, formatted``: the merged messages, the
    pieces of the output with a ``loss`` flag (true for the texts of
    ``trained_role``, never for marks), and the pieces joined.  Turns are sorted
    by number, ties by role and text, a null number first; null role or text is
    empty; a null ``conv_id`` is one conversation; repeated rows are repeated
    turns.  An empty table gives an empty result; other columns are ignored.
    A conversation is one row, so it has to fit a task.
    """
    per_chat = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    # Where a message begins: at the first turn and wherever the role changes.
    n = F.size("t")
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get("t", i)["role"] != F.get("t", i - 1)["role"]))
    with_runs = per_chat.withColumn("b", begins)
    messages = F.transform("b", lambda i, k: F.struct(
        F.get("t", i)["role"].alias("role"),
        F.transform(F.slice("t", i + 1, F.coalesce(F.get("b", k + 1), n) - i),
                    lambda x: x["text"]).alias("texts")))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(m: Column) -> Column:
        trained = m["role"] == F.lit(trained_role)
        head = piece(F.concat(F.lit(START), _escape_role(m["role"]), F.lit("\n")), F.lit(False))
        body = F.flatten(F.transform(m["texts"], lambda x, i: F.when(
            i == 0, F.array(piece(escape(x), trained))).otherwise(
            F.array(piece(F.lit(SEP), F.lit(False)), piece(escape(x), trained)))))
        return F.concat(F.array(head), body, F.array(piece(F.lit(END), F.lit(False))))

    return (with_runs.select("conv_id", messages.alias("messages"))
            .withColumn("segments", F.flatten(F.transform("messages", pieces)))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def parse_chat(formatted: Column) -> Column:
    """The turns ``array<struct<role,text>>`` read back from an output."""
    def turns(m: Column) -> Column:
        body = F.substring_index(m, END, 1)
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.length(role) + F.lit(2)), r"<\|im_sep\|>")
        return F.transform(texts, lambda x: F.struct(
            _unescape_role(role).alias("role"), unescape(x).alias("text")))

    marked = F.split(formatted, r"<\|im_start\|>")
    return F.flatten(F.transform(F.slice(marked, 2, F.size(marked)), turns))


def loss_text(segments: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
