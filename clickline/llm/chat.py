"""Chat formatting: an event log per conversation is folded into final messages, which are then rendered.

Events of a message: ``message`` and ``edit`` set its text, ``delta`` appends to it, and ``regenerate`` starts it
again (its own text, if any, first) and takes back every later turn written before. Events are ordered by ``seq``;
equal ones by kind, role and text.

The template is ``### role: text </turn>\\n`` for each turn. Inside roles and texts a backslash becomes ``\\b``, two
number signs ``#\\#`` and ``</turn`` becomes ``<\\/turn``; in roles a colon becomes ``\\c``. So neither mark can
appear inside a turn, and each text can be restored exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", " </turn>\n"
#: Kinds of event in the order that settles equal ``seq``; ``delta`` alone keeps what was there.
KINDS = ("message", "edit", "regenerate", "delta")
#: Events of a conversation that one window orders at once, when ``seq`` is dense.
EVENTS_PER_SLICE = 4_096
#: Turns whose places in a text are added up together.
CHUNK = 256


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("##"), F.lit("#\\#")), F.lit("</turn"), F.lit("<\\/turn"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("<\\/turn"), F.lit("</turn")), F.lit("#\\#"), F.lit("##"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log (conv_id, seq, turn, kind, role, text).

    Null texts count as empty, unknown or null kinds as ``delta``. A message's role is the last one given that is
    not null, else empty. Null ``seq`` and ``turn`` come first, and null ``conv_id`` is a conversation of its own.
    Repeated events apply as often as they appear. Other columns are ignored; an empty log gives no messages.

    What a later regeneration takes back is found without ordering a whole conversation at once: slices of
    ``seq`` pass on their earliest regenerated turn. Of a message's events only those since its text was last
    set are gathered, so a task holds final texts, never the history.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.lit(0))
    log = events.select(
        F.struct("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(rank == 0, len(KINDS)).otherwise(rank).cast("int").alias("rank"),
        F.col("seq").cast("long").alias("seq"),
        F.col("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    log = log.withColumn("at", F.struct("seq", "rank", "role", "text")).withColumn(
        "slice", F.coalesce(F.floor(F.col("seq") / EVENTS_PER_SLICE), F.lit(-(2**62)))
    )
    turn = F.coalesce("turn", F.lit(-(2**62)))
    regenerated = F.when(F.col("rank") == KINDS.index("regenerate") + 1, turn)
    later_slices = Window.partitionBy("conv").orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slices = log.groupBy("conv", "slice").agg(F.min(regenerated).alias("m"))
    slices = slices.select("conv", "slice", F.min("m").over(later_slices).alias("later"))
    later_rows = Window.partitionBy("conv", "slice").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    log = log.join(slices, ["conv", "slice"]).withColumn("near", F.min(regenerated).over(later_rows))
    from_turn = F.least(F.col("later"), F.col("near"))
    alive = log.where(from_turn.isNull() | (from_turn > turn)).select("conv", F.struct("turn").alias("turn"), "rank", "at")

    role = F.max(F.when(F.col("at.role").isNotNull(), F.struct("at.seq", "rank", "at.role", "at.text")))
    set_at = F.max(F.when(F.col("rank") < len(KINDS), F.col("at")))
    heads = alive.groupBy("conv", "turn").agg(set_at.alias("set_at"), F.coalesce(role["role"], F.lit("")).alias("role"))
    since = alive.join(heads, ["conv", "turn"]).where(F.col("set_at").isNull() | (F.col("at") >= F.col("set_at")))
    # Events equal to the one that set the text set it again: only one of them counts.
    since = since.withColumn("again", (F.col("at") == F.col("set_at")) & (F.col("rank") < len(KINDS)))
    parts = F.collect_list(F.when(F.col("again").isNull() | ~F.col("again"), F.col("at")))
    text = F.concat(
        F.coalesce(F.first("set_at")["text"], F.lit("")),
        F.array_join(F.transform(F.sort_array(parts), lambda a: a["text"]), ""),
    )
    return since.groupBy("conv", "turn").agg(F.first("role").alias("role"), text.alias("text")).select(
        F.col("conv.conv_id").alias("conv_id"), F.col("turn.turn").alias("turn"), "role", "text"
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, text; one row per turn): ``conv_id``,
    ``formatted`` and ``loss``, the spans (``start``, ``end``, in code points of ``formatted``) of the texts of
    ``loss_roles``, escapes included and marks not.

    Null roles and texts are empty, null turns come first. A rendered conversation is one value, so it must fit a
    row of Spark (2 GB), and its turns are gathered once, in the row that they become.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEAD), escape_role(role), F.lit(COLON))
    rows = messages.select(
        F.struct("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.concat(head, escape(text), F.lit(END)).alias("segment"),
        F.length(head).alias("head"),
        role.isin(*loss_roles).alias("in_loss"),
    )
    one = F.struct("turn", "segment", "head", "in_loss")
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    starts = _starts(F.transform("turns", lambda t: F.length(t["segment"]).cast("long")))

    def span(t: Column, start: Column) -> Column:
        end = start + F.length(t["segment"]) - len(END)
        return F.when(t["in_loss"], F.struct((start + t["head"]).alias("start"), end.alias("end")))

    return whole.withColumn("starts", starts).select(
        F.col("conv.conv_id").alias("conv_id"),
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
        F.array_compact(F.zip_with("turns", "starts", span)).alias("loss"),
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once, however often the lambdas in ``use`` read it."""
    return F.transform(F.array(value), use)[0]


def _starts(lengths: Column) -> Column:
    """The sum of the lengths before each one: within chunks, then over chunks, since an array that grows by
    one element is copied each time."""
    none = F.struct(F.lit(0).cast("long").alias("stop"), F.array().cast("array<bigint>").alias("starts"))

    def sums(values: Column, length: Callable[[Column], Column]) -> Column:
        return F.aggregate(
            values,
            none,
            lambda done, x: F.struct(
                (done["stop"] + length(x)).alias("stop"), F.concat(done["starts"], F.array(done["stop"])).alias("starts")
            ),
        )

    def chunks(every: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(every) - 1, F.lit(0)) / CHUNK).cast("int"))
        return F.transform(numbers, lambda i: sums(F.slice(every, i * CHUNK + 1, F.lit(CHUNK)), lambda x: x))

    def moved(parts: Column) -> Column:
        before = sums(parts, lambda part: part["stop"])["starts"]
        return F.flatten(F.zip_with(parts, before, lambda part, at: F.transform(part["starts"], lambda start: start + at)))

    return _once(_once(lengths, chunks), moved)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and, taken from the formatted text alone, ``turns`` (array of role and text) and
    ``loss_texts`` (array of the unescaped texts that ``loss`` covers, in order)."""
    marks = formatted.select(
        "conv_id", "formatted", "loss", F.split("formatted", rf"\Q{END}\E").alias("parts")
    ).withColumn("parts", F.slice("parts", F.lit(1), F.size("parts") - 1))
    marks = marks.withColumn("starts", _starts(F.transform("parts", lambda part: (F.length(part) + len(END)).cast("long"))))

    def turn(part: Column, start: Column) -> Column:
        colon = F.locate(COLON, part)
        return F.struct(
            unescape_role(F.substring(part, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"),
            unescape(F.substring(part, colon + len(COLON), F.length(part))).alias("text"),
            (start + colon + len(COLON) - 1).alias("start"),
            start.alias("at"),
            part.alias("part"),
        )

    turns = marks.withColumn("turns", F.zip_with("parts", "starts", turn))
    # Turns and spans in one order: the span of a turn follows it, so none has to be searched for.
    no_long, no_text = F.lit(None).cast("long"), F.lit(None).cast("string")

    def place(start: Column, span: int, end: Column, part: Column, at: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(span).alias("span"), end.alias("end"), part.alias("part"), at.alias("at"))

    of_turns = F.transform("turns", lambda t: place(t["start"], 0, no_long, t["part"], t["at"]))
    spans = F.transform("loss", lambda x: place(x["start"], 1, x["end"], no_text, no_long))
    neighbours = _once(
        F.sort_array(F.concat(of_turns, spans)),
        lambda both: F.zip_with(
            both, F.slice(both, F.lit(2), F.size(both)), lambda t, x: F.struct(t.alias("turn"), x.alias("span"))
        ),
    )
    covered = F.filter(
        neighbours,
        lambda n: (n["turn"]["span"] == 0) & (n["span"]["span"] == 1) & (n["turn"]["start"] == n["span"]["start"]),
    )

    def text(n: Column) -> Column:
        first = (n["turn"]["start"] - n["turn"]["at"] + 1).cast("int")
        return unescape(F.substring(n["turn"]["part"], first, (n["span"]["end"] - n["span"]["start"]).cast("int")))

    texts = F.transform(covered, text)
    return turns.select(
        "conv_id",
        "formatted",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        texts.alias("loss_texts"),
    )


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """A table of finished rows (conv_id, turn, role, text) as a log in which each row is one ``message``."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    number = F.row_number().over(order).cast("long")
    return conversations.select(
        "conv_id", number.alias("seq"), number.alias("turn"), F.lit("message").alias("kind"), "role", "text"
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """An event log to ``conv_id``, ``formatted`` and ``loss``: ``render`` of ``fold``."""
    return render(fold(events))
