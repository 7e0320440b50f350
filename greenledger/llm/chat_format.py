"""Chat formatting in budgeted, turn-aligned windows, with DataFrame functions only.

A conversation whose turns fit the token budget is one window. In a longer one, a turn of over half of
what the system turn leaves of the budget is long and has a window of its own. The stretches between
long turns are cut by prefix sums: a turn belongs to window ``start_tokens div stride`` of its stretch,
where ``stride`` leaves room in the budget for the system turn, the repeated history and the longest
turn that is not long, so no window needs a running decision and every turn lands whole in exactly one
window. As that turn takes half of the room at most, the stride is a quarter of it at least, whatever
long turns there are. Later windows repeat the system turn and the last turns before them, at most
``history`` tokens and what the budget leaves, as context that is never a target; a long turn is never
repeated, so a window right after one has no turn before it as context.

Windows are numbered without a running decision too: stretch j starts at ``2 j + start_tokens div
stride`` and the long turn after it has the number before the next stretch's; numbers ascend, with gaps.

Prefix sums are taken in two levels (blocks of turns, then offsets of blocks), and windows are
assembled one by one, so a conversation with very many turns is spread over tasks.

Tokens are estimated without Python: a quarter of the UTF-8 bytes, rounded up, plus ``TURN_TOKENS``
for the marks. Template of a turn: ``<|turn|>role<|text|>text<|end|>``. Control strings in roles and
texts get a backslash after their first character (one more than they already have), which
:func:`unescape` takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TURN_TOKENS = 4
#: Turn numbers that share a block of the two-level prefix sums.
BLOCK = 256
#: What starts a control string of this template or of common others (<|..|>, <s>, </s>, [INST], [/INST]).
_ESCAPE = r"<(\\*)(\||/?s>)", r"\[(\\*)(/?INST\])"


def escape(text: Column) -> Column:
    """Put a backslash after the first character of each control string."""
    text = F.regexp_replace(text, _ESCAPE[0], r"<\\$1$2")
    return F.regexp_replace(text, _ESCAPE[1], r"[\\$1$2")


def unescape(text: Column) -> Column:
    """Undo :func:`escape`."""
    text = F.regexp_replace(text, r"<\\(\\*)(\||/?s>)", r"<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def _tokens(text: Column) -> Column:
    return (F.ceil(F.octet_length(text) / 4) + TURN_TOKENS).cast("long")


def chat_windows(turns: DataFrame, budget: int = 2048, history: int = 256) -> DataFrame:
    """Format ``turns(conv_id, turn, role, text)`` into windows of at most ``budget`` tokens.

    Returns ``conv_id, window, context_turns, n_turns, n_tokens, over_budget, formatted, loss_spans``:
    ``context_turns`` leading turns repeat earlier ones; ``loss_spans`` are (start, len) in code points
    of ``formatted``, the escaped text of each assistant turn that is not context. A window is over
    budget only if the system turn and a single turn exceed the budget together.

    Rows are ordered by turn (null first), then role and text, so ties and repeated rows have a
    defined place and stay. Null role or text: empty. A null conv_id is a conversation like any other.
    Other columns are ignored.
    """
    t = turns.select(
        F.col("conv_id").alias("_c"),
        F.col("turn").cast("long").alias("_t"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    t = t.withColumn("_blk", F.coalesce(F.floor(F.col("_t") / BLOCK), F.lit(-(2**62)))).withColumn(
        "_tok", _tokens(F.col("_text"))
    )
    in_block = Window.partitionBy("_c", "_blk").orderBy(F.col("_t").asc_nulls_first(), "_role", "_text")
    upto = in_block.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_i", F.row_number().over(in_block) - 1)
    # What the whole conversation says: system turn, total.
    first = Window.partitionBy("_c").orderBy("_blk")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_c")
    heads = t.groupBy("_c", "_blk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_tok").alias("_sum"),
        F.min_by(F.struct("_role", "_text", "_tok"), F.col("_i")).alias("_head"),
    )
    heads = heads.select(
        F.col("_c").alias("_hc"),
        F.col("_blk").alias("_hb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_i0"),
        (F.sum("_sum").over(whole) <= budget).alias("_fits"),
        F.first("_head").over(first).alias("_head"),
    )
    t = t.join(heads, F.col("_c").eqNullSafe(F.col("_hc")) & (F.col("_blk") == F.col("_hb")))
    is_system = F.col("_head._role") == "system"
    t = t.select(
        *("_c", "_blk", "_t", "_role", "_text", "_tok", "_fits"),
        (F.col("_i0") + F.col("_i")).alias("_i"),
        F.when(is_system, F.struct("_head._role", "_head._text", "_head._tok")).alias("_sys"),
        (F.lit(budget) - F.when(is_system, F.col("_head._tok")).otherwise(0)).alias("_left"),
    )
    is_head = (F.col("_i") == 0) & F.col("_sys").isNotNull()
    t = t.withColumn("_long", ~F.col("_fits") & ~is_head & (2 * F.col("_tok") > F.col("_left")))
    # Two-level prefix sums: of all turns, of turns that are not long, of long ones, and where the stretch starts.
    t = t.withColumn("_all", F.when(is_head, 0).otherwise(F.col("_tok")))
    t = t.withColumn("_short", F.when(F.col("_long"), 0).otherwise(F.col("_all")))
    ahead = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    t = t.withColumn("_a", ahead("_all")).withColumn("_s", ahead("_short"))
    t = t.withColumn("_j", ahead(F.col("_long").cast("long")))
    t = t.withColumn("_cut", F.when(F.col("_long"), F.col("_s")))
    t = t.withColumn("_from", F.max("_cut").over(upto))
    blocks = t.groupBy("_c", "_blk").agg(
        F.sum("_all").alias("_all"),
        F.sum("_short").alias("_short"),
        F.sum(F.col("_long").cast("long")).alias("_longs"),
        F.max("_cut").alias("_cut"),
        F.max(F.when(~F.col("_long") & ~is_head, F.col("_tok"))).alias("_max"),
    )
    blocks = blocks.withColumn("_s0", F.coalesce(F.sum("_short").over(before), F.lit(0)))
    blocks = blocks.select(
        F.col("_c").alias("_bc"),
        F.col("_blk").alias("_bb"),
        F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_a0"),
        "_s0",
        F.coalesce(F.sum("_longs").over(before), F.lit(0)).alias("_j0"),
        F.coalesce(F.max(F.col("_s0") + F.col("_cut")).over(before), F.lit(0)).alias("_from0"),
        F.coalesce(F.max("_max").over(whole), F.lit(0)).alias("_most"),
    )
    t = t.join(blocks, F.col("_c").eqNullSafe(F.col("_bc")) & (F.col("_blk") == F.col("_bb")))
    room = F.col("_left") - F.col("_most")
    repeat = F.greatest(F.lit(0), F.least(F.lit(history), F.floor(room / 2)))
    spare = F.greatest(F.lit(0), F.least(F.lit(history), F.col("_left") - F.col("_tok")))
    t = t.select(
        *("_c", "_i", "_role", "_text", "_tok", "_sys", "_long"),
        (F.col("_a0") + F.col("_a")).alias("_a"),
        (F.col("_s0") + F.col("_s")).alias("_s"),
        (F.col("_j0") + F.col("_j")).alias("_j"),
        F.coalesce(F.col("_s0") + F.col("_from"), F.col("_from0")).alias("_from"),
        F.when(F.col("_long"), spare).otherwise(repeat).alias("_h"),
        F.when(F.col("_fits"), 0).otherwise(F.least(F.lit(history), F.floor(F.col("_left") / 2))).alias("_reach"),
        F.when(F.col("_fits"), F.lit(budget + 1)).otherwise(F.greatest(F.lit(1), room - repeat)).alias("_stride"),
    )
    alone = F.when((F.col("_j") == 0) & (F.col("_s") == 0), 0).otherwise(F.expr("2 * _j + 1 + _s div _stride"))
    t = t.withColumn("_w", F.when(F.col("_long"), alone).otherwise(F.expr("2 * _j + _from div _stride + (_s - _from) div _stride")))
    # Windows after the first repeat the system turn and recent turns.
    windows = t.groupBy(F.col("_c").alias("_wc"), F.col("_w").alias("_ww")).agg(
        F.min("_a").alias("_wa"), F.max("_h").alias("_wh"), F.first("_sys").alias("_wsys")
    )
    targets = t.select("_c", "_w", "_i", F.lit(False).alias("_ctx"), "_role", "_text", "_tok")
    late = t.where(~is_head & ~F.col("_long") & (F.col("_reach") > 0)).withColumn(
        "_w2", F.explode(F.expr("sequence(_w + 1, 2 * _j + 1 + (_s + _reach) div _stride)"))
    )
    late = late.join(windows, F.col("_c").eqNullSafe(F.col("_wc")) & (F.col("_w2") == F.col("_ww"))).where(
        F.col("_wa") - F.col("_a") <= F.col("_wh")
    )
    late = late.select("_c", F.col("_w2").alias("_w"), "_i", F.lit(True).alias("_ctx"), "_role", "_text", "_tok")
    system = windows.where((F.col("_ww") > 0) & F.col("_wsys").isNotNull()).select(
        F.col("_wc").alias("_c"),
        F.col("_ww").alias("_w"),
        F.lit(-1).cast("long").alias("_i"),
        F.lit(True).alias("_ctx"),
        F.col("_wsys._role").alias("_role"),
        F.col("_wsys._text").alias("_text"),
        F.col("_wsys._tok").alias("_tok"),
    )
    pieces = targets.unionByName(late).unionByName(system)
    pieces = pieces.withColumn("_head", F.concat(F.lit(TURN), escape(F.col("_role")), F.lit(TEXT)))
    pieces = pieces.withColumn("_body", escape(F.col("_text")))
    pieces = pieces.withColumn("_piece", F.concat("_head", "_body", F.lit(END)))
    ahead = Window.partitionBy("_c", "_w").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_at", F.coalesce(F.sum(F.length("_piece")).over(ahead), F.lit(0)))
    span = F.when(
        ~F.col("_ctx") & (F.col("_role") == "assistant"),
        F.struct(
            (F.col("_at") + F.length("_head")).cast("int").alias("start"),
            F.length("_body").cast("int").alias("len"),
        ),
    )
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_piece")))
    return pieces.groupBy(F.col("_c").alias("conv_id"), F.col("_w").alias("window")).agg(
        F.sum(F.col("_ctx").cast("int")).alias("context_turns"),
        F.count(F.lit(1)).alias("n_turns"),
        F.sum("_tok").alias("n_tokens"),
        (F.sum("_tok") > budget).alias("over_budget"),
        F.array_join(F.transform(ordered, lambda x: x["_piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Parse a formatted window back into an array of (role, text)."""
    blocks = F.split(formatted, r"<\|end\|>")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def one(block: Column) -> Column:
        body = F.substring(block, F.lit(len(TURN) + 1), F.length(block))
        parts = F.split(body, r"<\|text\|>", 2)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(blocks, one)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted windows: what they hold and what is under the loss mask.

    The digests run over a whole conversation by definition, so its text meets in one row here.
    """
    every = read_turns(F.col("formatted"))
    fresh = F.slice(every, F.col("context_turns") + 1, F.size(every))
    said = F.transform(fresh, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    masked = F.transform(
        "loss_spans", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["len"]))
    )
    per_window = windows.select(
        "conv_id",
        "window",
        F.size(fresh).cast("long").alias("n"),
        F.array_join(said, "").alias("said"),
        F.array_join(masked, "").alias("masked"),
        F.length("formatted").cast("long").alias("chars"),
    )
    parts = F.array_sort(F.collect_list(F.struct("window", "said", "masked")))
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), parts.alias("parts"), F.sum("chars").alias("formatted_chars")
    )
    loss = F.array_join(F.transform("parts", lambda x: x["masked"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda x: x["said"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
