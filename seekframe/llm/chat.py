"""Chat formatting by prefix-target expansion, in DataFrame functions alone.

Every assistant turn is an example of its own: all turns before it are its context, and its
reply alone is trainable. Contexts of a conversation's examples are prefixes of each other, so
the output stores each formatted turn once, at its place; ``examples`` writes one row for each
example, its target with the loss mask and the range of places that is its context, and
``expanded`` writes the examples out in full. Turns after the last
reply are the context of no example and are stored with no mask.

A formatted turn is ``### role: text </turn>`` and a line end. In roles and texts the
characters ``\\``, ``#``, ``<`` and, in roles, ``:`` are written as a backslash and a letter, so
no text can hold a mark, and reading back undoes it.

A null text or role is empty; rows of a conversation are ordered by turn (null first), ties by
role and text; repeated rows are repeated turns; rows without a conversation id form one
conversation of their own; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import parked

# Fixed values of the template.
HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
#: The letter after a backslash, for each character that is escaped; the backslash comes first and is undone last.
ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
TRAINED = "assistant"
#: Turns that are joined to one string before a conversation is put together: 64, as bits of a place.
BLOCK_BITS = 6


def escaped(text: Column, rules: tuple = ESCAPES) -> Column:
    for plain, written in rules:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, rules: tuple = ESCAPES) -> Column:
    for plain, written in reversed(rules):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def turns(conversations: DataFrame) -> DataFrame:
    """Formatted turns, parked: ``conv_id``, ``place``, ``turn``, ``segment``, and of replies the ``mask_start`` and ``mask_end`` in it.

    Places are distinct and rise by conversation, turn, role and text, so a context is a range
    of places. They are given to sorted rows and then written, as a second sort may cut elsewhere.
    """
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), ROLE_ESCAPES), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    trained = F.col("role") == TRAINED
    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    formatted = plain.orderBy(*order).select(
        "conv_id",
        F.monotonically_increasing_id().alias("place"),
        "turn",
        F.concat(head, body, F.lit(TAIL)).alias("segment"),
        F.when(trained, F.length(head)).cast("long").alias("mask_start"),
        F.when(trained, F.length(head) + F.length(body)).cast("long").alias("mask_end"),
    )
    return parked(formatted)


def examples(stored: DataFrame) -> DataFrame:
    """One row for each assistant turn: the target with its mask, and where its context begins.

    The context is the rows of ``stored`` from ``context_start`` on and before ``place``.
    """
    first = stored.groupBy("conv_id").agg(F.min("place").alias("context_start")).withColumnRenamed("conv_id", "_conv")
    targets = stored.where(F.col("mask_start").isNotNull()).withColumnRenamed("segment", "target")
    return targets.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def expanded(stored: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Examples in full: ``context`` and ``target``. Its size grows with the square of a conversation's turns.

    ``wanted`` (conv_id, turn) chooses examples, such as those of a batch.
    """
    targets = examples(stored)
    if wanted is not None:
        some = wanted.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"))
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn"))
        targets = targets.join(some, same, "left_semi")
    before = stored.select(F.col("conv_id").alias("_conv"), F.col("place").alias("_place"), "segment")
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_place") >= F.col("context_start")) & (F.col("_place") < F.col("place"))
    near = targets.select("conv_id", "place", "context_start").join(before, own)
    whole = near.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("_place", "segment"))).alias("_rows"))
    context = F.concat_ws("", F.col("_rows.segment"))
    joined = targets.join(whole.select("place", context.alias("context")), "place", "left")
    return joined.withColumn("context", F.coalesce("context", F.lit("")))


def read_back(stored: DataFrame, made: DataFrame) -> DataFrame:
    """All turns, parsed: replies and their loss from the targets of written examples, others from the examples' contexts.

    A context is read by its range, which must begin at a turn of the conversation: one that does
    not reads nothing, so its turns are missing. Turns after the last reply, and those of
    conversations without one, are in no example and come from ``stored``.
    """
    # Contexts of a conversation's examples are prefixes of the longest one. Parked, so that a long conversation is split in the joins.
    spans = made.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("context_start").alias("_from"), F.max("place").alias("_to"))
    spans = parked(spans)
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    first = stored.select(F.col("conv_id").alias("_own"), F.col("place").alias("_first"))
    begun = spans.join(first, F.col("_conv").eqNullSafe(F.col("_own")) & (F.col("_from") == F.col("_first")), "left_semi")
    rest = stored.where(F.col("mask_start").isNull())
    context = rest.join(begun, same & (F.col("place") >= F.col("_from")) & (F.col("place") < F.col("_to")), "left_semi")
    after = rest.join(spans, same & (F.col("place") < F.col("_to")), "left_anti")
    replies = made.withColumnRenamed("target", "segment").select(*stored.columns)
    return parsed(context.unionByName(after).unionByName(replies))


def parsed(stored: DataFrame) -> DataFrame:
    """Turns read back from formatted ones: ``role``, ``text`` and ``loss``, the text under the mask."""
    middle = F.locate(MIDDLE, F.col("segment"))
    role = F.col("segment").substr(F.lit(len(HEAD) + 1), middle - len(HEAD) - 1)
    body = F.col("segment").substr(middle + len(MIDDLE), F.length("segment") - middle - len(MIDDLE) - len(TAIL) + 1)
    loss = F.col("segment").substr((F.col("mask_start") + 1).cast("int"), (F.col("mask_end") - F.col("mask_start")).cast("int"))
    return stored.select(
        "conv_id",
        "place",
        "turn",
        unescaped(role, ROLE_ESCAPES).alias("role"),
        unescaped(body).alias("text"),
        unescaped(loss).alias("loss"),
        F.length("segment").cast("long").alias("chars"),
    )


def digests(read: DataFrame) -> DataFrame:
    """What a conversation holds, from its turns as read back.

    Turns are joined in blocks first, so that the rows of a long conversation come together
    from many tasks; its whole text must fit one string (2 GB), as its one digest needs it.
    """
    row = F.struct(
        F.col("place"),
        F.col("role"),
        F.col("text"),
        F.coalesce("loss", F.lit("")).alias("loss"),
    )
    rows = F.array_sort(F.collect_list(row))
    said = F.concat_ws("", F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.col("rows.loss"))
    blocks = (
        read.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"))
        .agg(rows.alias("rows"), F.count("*").alias("n"), F.sum("chars").alias("chars"))
        .select("conv_id", "n", "chars", F.struct("block", said.alias("said"), loss.alias("loss")).alias("part"))
    )
    whole = blocks.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = {c: F.concat_ws("", F.col(f"parts.{c}")) for c in ("said", "loss")}
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(joined["said"], 256).alias("turns_sha256"),
        F.length(joined["loss"]).cast("long").alias("loss_chars"),
        F.sha2(joined["loss"], 256).alias("loss_sha256"),
        "formatted_chars",
    )
