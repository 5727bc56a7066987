"""Chat formatting (operator 8, DataFrame functions only): event-sourced reconstruction, then rendering with a loss mask.

Events are rows (conv_id, seq, turn, kind, role, text). They are partitioned by conversation and folded in the order of
seq (ties by turn, kind, role, text):
  message     sets the turn's role and text          delta       appends to the turn's text
  edit        replaces the turn's text               delete      removes the turn
  regenerate  empties the turn's text, for deltas to rebuild it, and removes the events of later turns before it
A later message, edit, regenerate or delete makes the turn's earlier texts void; its deltas since are joined in order.
Unknown or null kinds count as delta, null texts and roles as empty. The role is that of the turn's last event with one.

Template: ``[INST]role[/INST]text</s>`` per turn. In roles and texts ``\\``, ``<`` and ``[`` become ``\\b``, ``\\l`` and
``\\i``, so no control string can occur in them, and reading back is exact. ``loss_spans`` lists (start, chars) of every
assistant text in the formatted string, in code points.

A turn is folded on its own, so a very long conversation is split up to that point; its rendered string is one value by
nature and is built once. Null conv_ids form one conversation. No events, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import table

RESETS = ("message", "edit", "regenerate", "delete")
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    for char, code in (("\\", "\\b"), ("<", "\\l"), ("[", "\\i")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    # after escaping, b, l or i follows each backslash, so the order "l, i, b" is exact
    for char, code in (("<", "\\l"), ("[", "\\i"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def join_in_order(order: Column, text: Column) -> Column:
    """Concatenates the group's texts by the given order (an aggregate)."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), "")


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of event logs."""
    e = events.select("conv_id", "seq", "turn", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    by = Window.partitionBy("conv_id").orderBy("seq", "turn", "kind", "role", "text")
    e = e.withColumn("ord", F.row_number().over(by))
    later = Window.partitionBy("conv_id").orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    e = e.withColumn("cut", cut).where("cut is null or turn <= cut")
    turn = Window.partitionBy("conv_id", "turn")
    last = F.max(F.when(F.col("kind").isin(*RESETS), F.col("ord"))).over(turn)
    e = e.withColumn("last", F.coalesce(last, F.lit(0)))
    live = F.col("ord") >= F.col("last")
    shown = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.col("text"))
    gone = F.max(F.when((F.col("ord") == F.col("last")) & (F.col("kind") == "delete"), True).otherwise(False))
    folded = e.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("ord"))).alias("role"),
        join_in_order(F.col("ord"), F.when(live, shown).otherwise(F.lit(""))).alias("text"), gone.alias("gone"))
    return folded.where(~F.col("gone")).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "text")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of messages (conv_id, turn, role, text)."""
    m = messages.withColumn("role_out", escape(F.col("role"))).withColumn("text_out", escape(F.col("text")))
    m = m.withColumn("head", F.concat(F.lit(OPEN), "role_out", F.lit(CLOSE)))
    m = m.withColumn("turn_out", F.concat("head", "text_out", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("turn_out")).over(before), F.lit(0)) + F.char_length("head")
    m = m.withColumn("span", F.when(F.col("role") == "assistant", F.struct(
        start.cast("long").alias("start"), F.char_length("text_out").cast("long").alias("chars"))))
    return m.groupBy("conv_id").agg(join_in_order(F.col("turn"), F.col("turn_out")).alias("formatted"),
                                    F.array_sort(F.collect_list("span")).alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, loss): the turns of formatted conversations; loss is the text under the mask, or null.

    Turns come from the control strings alone, the loss text from the mask's spans alone.
    """
    r = rendered.select("conv_id", F.posexplode(F.split("formatted", END)).alias("turn", "raw"), F.char_length("formatted").alias("whole"))
    # the split leaves an empty piece behind the last end mark
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("start", F.coalesce(F.sum(F.char_length("raw") + len(END)).over(before), F.lit(0)).cast("long"))
    r = r.where("raw <> ''")
    mark = F.instr("raw", CLOSE)
    r = r.withColumn("mark", mark)
    r = r.select("conv_id", "turn", "start", "raw", F.substring(F.col("raw"), F.lit(len(OPEN) + 1), F.col("mark") - 1 - len(OPEN)).alias("role"),
                 F.substring(F.col("raw"), F.col("mark") + len(CLOSE), F.char_length("raw")).alias("text"),
                 (F.col("start") + F.col("mark") - 1 + len(CLOSE)).alias("text_start"))
    spans = rendered.select(F.col("conv_id").alias("c"), F.inline("loss_spans")).select("c", F.col("start").alias("at"), "chars")
    r = r.join(spans, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("text_start") == F.col("at")), "left")
    loss = F.substring(F.col("raw"), F.col("at") - F.col("start") + 1, F.col("chars"))
    return r.select("conv_id", "turn", unescape(F.col("role")).alias("role"), unescape(F.col("text")).alias("text"),
                    unescape(F.when(F.col("at").isNotNull(), loss)).alias("loss"))


def format_digest(rendered: DataFrame) -> DataFrame:
    turns = read_back(rendered).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sha2(join_in_order(F.col("turn"), F.concat("role", F.lit("\n"), "text", F.lit("\n"))), 256).alias("turns_sha256"),
        join_in_order(F.col("turn"), F.coalesce("loss", F.lit(""))).alias("loss"))
    sizes = rendered.select(F.col("conv_id").alias("c"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return turns.join(sizes, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def conversation_events(rows: DataFrame) -> DataFrame:
    """Message events of finished conversations (conv_id, turn, role, text): every row is a turn of its own, by
    (turn, role, text), so rows of equal turn are all kept."""
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", order.alias("seq"), order.alias("turn"), F.lit("message").alias("kind"), "role", "text")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema))
    return format_digest(render(reconstruct(conversation_events(rows))))


_ESC = "replace(replace(replace({}, '\\', '\\b'), '<', '\\l'), '[', '\\i')"

OP8_SQL = f"""
with c as (select conv_id, turn, role, text from conversations
   union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
 t as (select conv_id, row_number() over (partition by conv_id order by turn, role, text) as i, coalesce(role, '') as role,
    coalesce(text, '') as text from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  sum({len(OPEN + CLOSE + END)} + length({_ESC.format('role')}) + length({_ESC.format('text')}))::bigint as formatted_chars
from t group by conv_id
"""
