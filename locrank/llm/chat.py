"""Chat formatting from event logs: messages are folded from deltas, edits and regenerations, then
rendered with a template whose marks cannot occur inside a text. DataFrame functions only.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

#: A turn is OPEN role SEPARATOR text CLOSE.
OPEN, SEPARATOR, CLOSE = "<s>", "<|text|>", "</s>"

# A control string is one of these after its first character, which is "<" or "[".
_REST = r"(?:s>|/s>|\|text\|>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"


def escaped(text):
    """Text in which every control string has a backslash more after its first character."""
    return F.regexp_replace(text, r"([<\[])(\\*" + _REST + ")", r"$1\\$2")


def unescaped(text):
    """The inverse of escaped."""
    return F.regexp_replace(text, r"([<\[])\\(\\*" + _REST + ")", "$1$2")


def fold(events):
    """conv_id, message, role, text: final messages of events(conv_id, seq, message, kind, role, text).

    In the order of seq, a `delta` appends its text to the message, an `edit` puts its text in place
    of the message so far, and a `regenerate` discards the message so far and every later message
    that began before it; its text, if any, begins the new version. The role is that of the last
    event that stays and has one.

    * Null texts are empty. Events with equal seq are taken in the order of kind and text.
    * A null conv_id is a conversation, a null message its first message, a null seq comes first.
    * Repeated rows are events of their own; an empty log has no message; other columns are ignored.

    Logs are grouped by conversation and message, so a conversation of any length is spread over
    tasks; only one row per message meets in the running maximum along a conversation.
    """
    events = events.select("conv_id", "seq", "message", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    numbered = events.withColumn("at", F.coalesce(F.col("seq").cast("long"), F.lit(-(2**62))))
    message = ["conv_id", "message"]
    marks = numbered.groupBy(*message).agg(
        F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("at"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("at"))).alias("discard"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("discarded", F.max("discard").over(earlier)).drop("discard")
    marks = marks.withColumnsRenamed({"conv_id": "_conv_id", "message": "_message"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("message").eqNullSafe(F.col("_message"))
    stay = (F.col("reset").isNull() | (F.col("at") >= F.col("reset"))) & (
        F.col("discarded").isNull() | (F.col("at") > F.col("discarded"))
    )
    left = numbered.join(marks, same).where(stay)
    ordered = F.array_sort(F.collect_list(F.struct("at", "kind", "text", "role")))
    folded = left.groupBy(*message).agg(ordered.alias("events"))
    # An edit or regeneration with the seq of a delta comes after it; what is before it is replaced.
    last = F.aggregate(
        F.transform("events", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(0)),
        F.lit(0),
        lambda best, i: F.greatest(best, i),
    )
    live = F.slice("events", last + 1, F.size("events"))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda role: role.isNotNull())
    text = F.array_join(F.transform(live, lambda e: e["text"]), "")
    return folded.select(*message, F.try_element_at(roles, F.lit(-1)).alias("role"), text.alias("text"))


def render(messages, loss_role="assistant"):
    """conv_id, formatted, loss_spans(start, length) for every conversation of messages(conv_id, message, role, text).

    Turns come in the order of message, loss_spans are the code points of the texts of loss_role.
    A null role or text is empty; messages of equal number come in the order of role and a hash of the
    text. A null conv_id is a conversation. No messages give no row; other columns are ignored.

    Places are running sums of lengths along a conversation, without its texts; the texts meet once,
    in the one formatted row that is the result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escaped(role), F.lit(SEPARATOR))
    turns = messages.select("conv_id", "message", role.alias("role"), head.alias("head"), escaped(text).alias("body"))
    turns = turns.withColumns(
        {
            "key": F.xxhash64("body"),
            "before": F.char_length("head").cast("long"),
            "inside": F.char_length("body").cast("long"),
        }
    )
    place = ["message", "role", "key", "inside"]
    order = Window.partitionBy("conv_id").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    whole = F.col("before") + F.col("inside") + len(CLOSE)
    sized = turns.select("conv_id", *place, "before").withColumn("start", F.sum(whole).over(order) - whole + F.col("before"))
    spans = F.collect_list(F.when(F.col("role") == loss_role, F.struct("start", F.col("inside").alias("length"))))
    spans = sized.groupBy("conv_id").agg(F.array_sort(spans).alias("loss_spans"))
    turn = F.concat("head", "body", F.lit(CLOSE)).alias("turn")
    parts = F.array_sort(F.collect_list(F.struct(*place, turn)))
    done = turns.groupBy(F.col("conv_id").alias("conversation")).agg(parts.alias("parts"))
    done = done.join(spans, F.col("conversation").eqNullSafe(F.col("conv_id")))
    formatted = F.array_join(F.transform("parts", lambda part: part["turn"]), "")
    return done.select("conv_id", formatted.alias("formatted"), "loss_spans")


def read_back(formatted):
    """conv_id, turns(role, text) and loss texts, read from render's conv_id, formatted and loss_spans alone."""
    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda piece: piece != "")

    def turn(piece):
        sides = F.split(F.substring(piece, len(OPEN) + 1, 2**31 - 1), r"<\|text\|>", 2)
        return F.struct(unescaped(sides[0]).alias("role"), unescaped(sides[1]).alias("text"))

    def lost(span):
        return unescaped(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    turns, loss = F.transform(pieces, turn), F.transform("loss_spans", lost)
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted")


def numbered(turns):
    """turns(conv_id, turn, role, text) with message: 0, 1, ... in each conversation, by turn, role and text.

    Rows of one turn are messages of their own. The texts are only sorted within a turn; along a
    conversation go the numbers of rows per turn.
    """
    counts = turns.groupBy("conv_id", "turn").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conv_id").alias("conversation"), F.col("turn").alias("at"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first")
    )
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) - 1
    same = F.col("conv_id").eqNullSafe(F.col("conversation")) & F.col("turn").eqNullSafe(F.col("at"))
    placed = turns.withColumn("place", place).join(counts, same)
    return placed.select("conv_id", (F.col("first") + F.col("place")).alias("message"), "role", "text")


def logged(messages):
    """An event log, in no order, whose fold is messages(conv_id, message, role, text) with twice their numbers.

    Every text is streamed in three deltas. By a hash of conversation and number, a fifth of the
    messages are edited: a draft comes first, and an edit begins the text. Of the others a sixth are
    regenerated: a first version and an answer to it, the message of the odd number after, come
    before, and both are discarded.
    """
    text = F.coalesce("text", F.lit(""))
    third = F.ceil(F.char_length(text) / 3).cast("int")
    pieces = [F.substring(text, third * k + 1, third if k < 2 else F.char_length(text)) for k in range(3)]
    draw = F.pmod(F.xxhash64("conv_id", "message"), F.lit(30))
    kind = F.when(draw < 6, "edit").when(draw < 10, "regenerate").otherwise("delta")
    number = 2 * F.col("message")

    def event(seq, kind, text, message=number, when=None):
        entry = F.struct(
            (8 * F.col("message") + seq).cast("long").alias("seq"), message.cast("long").alias("message"), kind.alias("kind"), "role", text.alias("text")
        )
        return entry if when is None else F.when(when, entry)

    changed, again = F.col("begins") != "delta", F.col("begins") == "regenerate"
    events = F.array(
        event(6, F.lit("delta"), pieces[2]),
        event(1, F.lit("delta"), F.lit("an answer to a first version"), number + 1, again),
        event(4, F.col("begins"), pieces[0]),
        event(0, F.lit("delta"), F.concat(F.lit("a draft of "), pieces[0]), when=changed),
        event(5, F.lit("delta"), pieces[1]),
    )
    events = F.explode(F.filter(events, lambda e: e.isNotNull()))
    return messages.withColumn("begins", kind).select("conv_id", events.alias("e")).select("conv_id", "e.*")


def op4_chat(spark, sf_dir):
    """Every conversation as a log of deltas, edits and regenerations, folded, rendered and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    ok = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2, numPartitions=1).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        ok,
    )
    back = read_back(render(fold(logged(numbered(rows.unionByName(extra))))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = (
    r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, '([<\[])(\\*"""
    + _REST
    + r""")', '\1\\\2', 'g') AS r, regexp_replace(text, '([<\[])(\\*"""
    + _REST
    + r""")', '\1\\\2', 'g') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(r) + length(t) + 15)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
)
