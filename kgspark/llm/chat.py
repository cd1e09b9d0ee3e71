r"""Chat formatting by event-sourced reconstruction, DataFrame functions only.

Input is a log of events per conversation. ``reconstruct`` folds it into final messages,
``render`` writes them with a reversible template and a loss mask, ``read_turns`` and
``read_loss`` read both back from the rendered rows.

Events: ``conv_id``, ``seq`` (order within the conversation), ``kind``, ``turn``, ``role``,
``text``. Kinds:

* ``message``    -- a whole text for its turn (same as ``edit`` if the turn has text already);
* ``delta``      -- text appended to its turn;
* ``edit``       -- replaces the text of its turn by this text;
* ``regenerate`` -- drops the turn's text and every later turn logged so far; deltas follow.

Template: ``<|start|>role<|text|>text<|end|>`` per turn. Inside roles and texts ``\`` becomes
``\\`` and ``<|`` becomes ``<\|``, so no control string of the template can occur in them and
``unescape`` restores them exactly.

Defined cases: null text or role is empty; a null kind is a ``message``; events of equal ``seq`` are
ordered by turn, kind, role, text; a null conv_id is a conversation of its own; an empty log
gives no rows; other columns are ignored. A conversation is one output row (its text is one
document by contract), so ``conversation_events`` deals its rows by conversation at once: all later
groupings are by keys that begin with it, and texts cross one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, SEP, END = "<|start|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``turn``, ``pos`` (place of the message in its conversation's
    log), ``role``, ``text``. A turn's text is its last reset (message, edit, regenerate) and the
    deltas after it; a regenerated turn removes later turns that were logged before it."""
    log = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = _cuts(log)
    here = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    # what was logged before the cut goes; at its very seq the earlier turn's regeneration comes first
    kept = log.join(cuts, here, "left").where(F.col("cut").isNull() | (F.col("seq") >= F.col("cut")))
    # per turn, in one pass: its events in order; small, as one message's own history
    turns = kept.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"))
    resets = F.transform("log", lambda e: e["kind"] != "delta")
    last = F.array_position(F.reverse(resets), True).cast("int")  # from the end; 0 if there is none
    turns = turns.withColumn("last", last).withColumn("live", F.when(F.col("last") > 0, F.slice(
        "log", F.size("log") - F.col("last") + 1, F.col("last"))).otherwise(F.col("log")))
    text = F.array_join(F.transform("live", lambda e: F.when(e["kind"] == "regenerate", F.lit(""))
                                    .otherwise(e["text"])), "")
    role = F.array_max(F.transform("live", lambda e: e["role"]))
    return turns.select("conv_id", "turn", F.col("log")[0]["seq"].alias("pos"), role.alias("role"),
                        text.alias("text"))


def _cuts(log: DataFrame) -> DataFrame:
    """``c``, ``t``, ``cut``: for each turn after a regenerated one the last such regeneration's ``seq``. A running
    maximum over the turns of the conversations that have any, without texts."""
    again = log.where((F.col("kind") == "regenerate") & F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(
        F.max("seq").alias("s")).select(F.col("conv_id").alias("rc"), F.col("turn").alias("rt"), "s")
    some = again.select(F.col("rc").alias("sc")).distinct()
    turns = (log.where("turn is not null").select(F.col("conv_id").alias("c"), F.col("turn").alias("t")).distinct()
             .join(some, F.col("c").eqNullSafe(F.col("sc")), "left_semi"))
    before = Window.partitionBy("c").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    return (turns.join(again, F.col("c").eqNullSafe(F.col("rc")) & (F.col("t") == F.col("rt")), "left")
            .withColumn("cut", F.max("s").over(before)).where("cut is not null").select("c", "t", "cut"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``segments`` (text, loss), whose texts joined
    are ``formatted``; the segments with ``loss`` are the mask."""
    header = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    one = messages.select("conv_id", F.struct(
        "pos", "turn", "role", header.alias("header"), escape(F.col("text")).alias("body")).alias("m"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform(F.array_sort("ms"), lambda m: F.array(
        piece(m["header"], F.lit(False)), piece(m["body"], m["role"] == LOSS_ROLE),
        piece(F.lit(END), F.lit(False)))))
    return (one.groupBy("conv_id").agg(F.collect_list("m").alias("ms"))
            .select("conv_id", segments.alias("segments"))
            .select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), parsed from the rendered string alone."""
    pieces = F.split(formatted, r"\<\|end\|\>")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(turns, lambda t: F.struct(
        unescape(F.regexp_replace(F.substring_index(t, SEP, 1), r"^\<\|start\|\>", "")).alias("role"),
        unescape(F.substring_index(t, SEP, -1)).alias("text")))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered rows say, read back from them."""
    back = rendered.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                           read_loss(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A table of turns as a log: each row is one message event. Rows of one conversation are
    ordered by turn (null first), ties by role and text; repeated rows are repeated messages."""
    place = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    counted = (conversations.select("conv_id", place.alias("p")).repartition("conv_id")
               .groupBy("conv_id", "p").agg(F.count(F.lit(1)).alias("n")))
    copies = counted.select("conv_id", "p", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    key = F.struct("p.turn", "p.role", "p.text", "copy")
    return copies.select("conv_id", key.alias("seq"), F.lit("message").alias("kind"),
                         key.alias("turn"), F.col("p.role").alias("role"), F.col("p.text").alias("text"))
