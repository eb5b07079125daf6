"""Chat formatting of preference pairs.

A pair holds two conversations, chosen and rejected.  Their longest common
prefix of turns (role and text equal) is rendered once as the prompt; the turns
after it are the completions, each with a mask: the character ranges of its
assistant turns' texts and end marks, which are the parts to learn.

``pairs`` makes pairs from one table of conversations: chosen is a whole
conversation as it stands, trailing turns included; rejected is the same
conversation with its last assistant turn and what follows replaced by the last
assistant turn of its partner (the conversation whose id differs in the last
binary digit).  Every turn is in the prompt or in a completion.

Each turn's end within its rendered conversation is a running sum over the
conversation's rows, so masks take no more work than the turns themselves.

Defined results.  Null roles count as ``unknown`` and null texts as empty;
turns come in order of (turn, role, text), null turns first.  Rows without a
conversation id take no part.  Repeated rows are repeated turns.  A conversation
without an assistant turn is all prompt, its completions are empty.  Without a
partner that has an assistant turn the rejected completion is empty.  An empty
table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


def _size(turn: Column) -> Column:
    """Code points of a rendered turn."""
    return (F.char_length(turn["role"]) + F.char_length(turn["text"]) + len("<||>\n") + len(CLOSE)).cast("long")


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and its turns in order: an array of (role, text, end), end being
    the code points of the conversation rendered up to here."""
    clean = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"),
    )
    upto = Window.partitionBy("conv_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ended = clean.withColumn("end", F.sum(_size(F.col("t"))).over(upto))
    listed = ended.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("end", "t"))).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda x: F.struct(x["t"]["role"].alias("role"), x["t"]["text"].alias("text"), x["end"].alias("end"))).alias("turns"))


def last_assistant(turns: Column) -> Column:
    """Place of the last assistant turn, from 1; 0 if there is none."""
    n = F.size(turns)
    back = F.array_position(F.transform(F.reverse(turns), lambda x: x["role"]), "assistant")
    return F.when(back > 0, n - back + 1).otherwise(0).cast("int")


def pairs(turns: DataFrame) -> DataFrame:
    """pair_id, chosen, rejected (arrays of turns) from one table."""
    whole = conversations(turns).withColumn("last", last_assistant(F.col("turns")))
    reply = F.element_at("turns", F.col("last"))
    other = whole.where("last > 0").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.struct(reply["role"].alias("role"), reply["text"].alias("text")).alias("reply"))
    # what comes before the last assistant turn; all turns where there is none
    before = F.when(F.col("last") > 0, F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))).otherwise(F.col("turns"))
    start = F.coalesce(F.get("before", F.size("before") - 1)["end"], F.lit(0).cast("long"))
    answer = F.struct(F.col("reply.role"), F.col("reply.text"), (start + _size(F.col("reply"))).alias("end"))
    rejected = F.when((F.col("last") > 0) & F.col("reply").isNotNull(), F.concat("before", F.array(answer))).otherwise(F.col("before"))
    return whole.join(other, "conv_id", "left").withColumn("before", before).select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns the longest common prefix has."""
    same = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    miss = F.array_position(same, False)
    return F.when(miss > 0, miss - 1).otherwise(F.size(a)).cast("int")


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column, base: Column) -> Column:
    """Ranges [start, end) of the rendered turns that are learnt, in code points
    after ``base``: an assistant turn without its opening mark."""
    learnt = F.filter(turns, lambda s: s["role"] == "assistant")
    return F.transform(learnt, lambda s: F.struct((s["end"] - base - F.char_length(s["text"]) - len(CLOSE)).cast("int").alias("start"), (s["end"] - base).cast("int").alias("end")))


def format_pairs(paired: DataFrame) -> DataFrame:
    """pair_id, prompt_turns, prompt, chosen, chosen_mask, rejected,
    rejected_mask of (pair_id, chosen, rejected); turns as ``conversations``
    gives them."""
    n = F.col("n")
    tail = lambda c: F.slice(F.col(c), n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    cut = paired.withColumn("n", common_turns(F.col("chosen"), F.col("rejected"))).select(
        "pair_id", F.col("n").alias("prompt_turns"), F.slice("chosen", F.lit(1), n).alias("p"), tail("chosen").alias("c"), tail("rejected").alias("r")
    )
    base = F.coalesce(F.get("p", F.size("p") - 1)["end"], F.lit(0).cast("long"))
    return cut.select(
        "pair_id", "prompt_turns", render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), mask(F.col("c"), base).alias("chosen_mask"),
        render(F.col("r")).alias("rejected"), mask(F.col("r"), base).alias("rejected_mask"),
    )
