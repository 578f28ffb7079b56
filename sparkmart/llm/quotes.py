"""Chat formatting by quotation links: who answers whom, in reply order, without the quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import let, numbered, running_sums
from sparkmart.operators.asof import asof_join
from sparkmart.session import settle

# How lines end that announce a quote (English, German, French, Spanish).
ANNOUNCED = r"(?i)^.{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"
MARKS = r"^(?:[ \t]*>)+"
_PLACE = ["_row", "_no_conv", "_conv", "_at", "_pos"]


def quote_level(line: Column) -> Column:
    """Number of ``>`` marks that a line begins with; blanks may stand between them."""
    return F.length(F.translate(F.regexp_extract(line, MARKS, 0), " \t", ""))


def unquoted_text(text: Column) -> Column:
    """The text without quoted lines and without lines that announce a quote."""

    def own(lines: Column) -> Column:
        def keep(line: Column, at: Column) -> Column:
            follows = F.coalesce(quote_level(F.get(lines, at + 1)) > 0, F.lit(False))
            return (quote_level(line) == 0) & ~(follows & F.rlike(line, F.lit(ANNOUNCED)))

        return F.array_join(F.filter(lines, keep), "\n")

    body = let(F.split(F.coalesce(text, F.lit("")), "\n", -1), own)
    return F.regexp_replace(body, r"(?s)^\s*\n|\s+$", "")


def _plain(line: Column) -> Column:
    """The text of a line without quote marks: lower case, white space folded."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """One row per line that is not blank: its level, its normalised text."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    cut = messages.select(*_PLACE, F.posexplode(lines).alias("line_no", "line"))
    return cut.select(*_PLACE, "line_no", quote_level(F.col("line")).alias("level"), _plain(F.col("line")).alias("plain")).where(
        "plain <> ''"
    )


def _passages(messages: DataFrame) -> DataFrame:
    """Lines of quoted passages (runs of lines of one level), with the number of the passage in its message."""
    in_message = Window.partitionBy("_row").orderBy("line_no")
    begins = F.coalesce(F.lag("level").over(in_message) != F.col("level"), F.lit(True))
    cut = _lines(messages.where(F.rlike("text", F.lit(r"(?m)^[ \t]*>")))).withColumn("_begins", begins.cast("int"))
    return cut.withColumn("passage", F.sum("_begins").over(in_message)).where("level > 0").drop("_begins")


def _own_words(text: Column) -> Column:
    """Words of the lines a message says itself."""
    own = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: quote_level(line) == 0)
    return F.filter(F.split(_plain(F.array_join(own, " ")), " "), lambda w: w != "")


def _with_runs(df: DataFrame, levels: int) -> DataFrame:
    """Add ``runs``: for each k below ``levels`` the hashes of the 2**k words from each word on.

    The hash of a run is that of its two halves, so every level costs one pass over the words.
    """
    run = F.transform("words", lambda w: F.xxhash64(w))
    names = []
    for k in range(levels):
        names.append(f"_run{k}")
        df = df.withColumn(names[-1], run)
        half, this = 1 << k, F.col(names[-1])
        left = F.slice(this, F.lit(1), F.greatest(F.size(this) - half, F.lit(0)))
        right = F.slice(this, F.lit(half + 1), F.greatest(F.size(this) - half, F.lit(0)))
        run = F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))
    return df.select("*", F.array(*names).alias("runs")).drop(*names)


def _holders(messages: DataFrame, passages: DataFrame) -> DataFrame:
    """``_row, passage, _source``: the latest earlier message of the conversation that holds a whole passage.

    A passage of m words, 2**k <= m < 2**(k+1), is known by its first and its last 2**k words and by m. Originals look up
    the run of 2**k words from each of their words on; where it begins a passage, their run that ends where the passage
    would end must be its last one. So line ends do not matter, and passages quoted often are looked up once.
    """
    whole = passages.groupBy(*_PLACE, "passage").agg(F.sort_array(F.collect_list(F.struct("line_no", "plain"))).alias("lines"))
    words = F.split(F.array_join(F.transform("lines", lambda x: x["plain"]), " "), " ")
    whole = settle(whole.select(*_PLACE, "passage", words.alias("words")), "quote-passages")
    longest = whole.agg(F.max(F.size("words"))).first()[0] or 0
    if not longest:
        return None
    levels = longest.bit_length()  # of the number of words, so few
    size = F.size("words")
    level = sum((F.when(size >= 1 << k, 1).otherwise(0) for k in range(1, levels)), F.lit(0))
    known = _with_runs(whole, levels).withColumn("k", level)
    of_level = F.get("runs", F.col("k"))
    key = ["_no_conv", "_conv", "k", "run", "m", "end"]
    known = known.select(
        *_PLACE, "passage", "k", size.alias("m"), F.get(of_level, F.lit(0)).alias("run"),
        F.get(of_level, size - F.pow(F.lit(2), F.col("k")).cast("int")).alias("end"),
    )
    known = settle(known, "quote-known")
    classes = known.select(*key).distinct()
    asked = messages.join(known.select("_no_conv", "_conv").distinct(), ["_no_conv", "_conv"], "left_semi")
    said = settle(_with_runs(asked.select(*_PLACE, _own_words(F.col("text")).alias("words")), levels).drop("words"), "quote-runs")
    starts = said.select("_row", "_no_conv", "_conv", F.posexplode("runs").alias("k", "level_runs")).select(
        "_row", "_no_conv", "_conv", "k", F.posexplode("level_runs").alias("i", "run")
    )
    met = starts.join(classes, ["_no_conv", "_conv", "k", "run"]).groupBy("_row").agg(
        F.collect_set(F.struct("k", "i", "run", "m", "end")).alias("met")
    )
    last = lambda c: F.get(F.get("runs", c["k"]), c["i"] + c["m"] - F.pow(F.lit(2), c["k"]).cast("int"))
    held = said.join(met, "_row").select(*_PLACE, F.explode(F.filter("met", lambda c: last(c) == c["end"])).alias("c"))
    held = held.select(*_PLACE, "c.k", "c.run", "c.m", "c.end").distinct()
    # places in the conversation are numbers, for the as-of join; an earlier message is one that stands before
    return asof_join(
        known.select(*key, "_row", "passage", (F.col("_pos") - 1).alias("_before")),
        held.select(*key, "_pos", F.struct("_at", "_row").alias("_holder"), F.col("_row").alias("_held_by")),
        [(c, c) for c in key],
        "_before",
        "_pos",
        {"_source": "_holder"},
        how="inner",
        ties=("_held_by",),
    ).select("_row", "passage", "_source")


def _links(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replies (``_row``, ``_parent``) and, per message with quotes, how many passages it has and links."""
    line_key = ["_no_conv", "_conv", "hash"]
    hashed = _lines(messages).withColumn("hash", F.xxhash64("plain"))
    # where no message says a passage as a whole: the first message that says a line itself
    originals = (
        hashed.where("level = 0").groupBy(*line_key).agg(F.min(F.struct("_at", "_row")).alias("first"))
    )
    passages = settle(_passages(messages), "quote-lines")
    found = passages.withColumn("hash", F.xxhash64("plain")).join(originals, line_key, "left").withColumn(
        "_source", F.when(F.col("first._at") < F.col("_at"), F.col("first"))
    )
    weighed = found.groupBy("_row", "passage", "level", "_source").agg(F.sum(F.length("plain")).alias("said"))
    # the message that says most of a passage; of equals, the latest
    best = F.max(F.when(F.col("_source").isNotNull(), F.struct("said", "_source")))
    per_passage = weighed.groupBy("_row", "passage", "level").agg(best.alias("best"), F.sum("said").alias("all"))
    holders = _holders(messages, passages)
    if holders is not None:
        whole = holders.withColumnRenamed("_source", "_whole")
        said = F.struct(F.col("all").alias("said"), F.col("_whole").alias("_source"))
        per_passage = per_passage.join(whole, ["_row", "passage"], "left").withColumn(
            "best", F.when(F.col("_whole").isNotNull(), said).otherwise(F.col("best"))
        )
    # the parent is what the shallowest linked passage quotes; of those, the longest
    shallow = F.max(F.when(F.col("best").isNotNull(), F.struct((-F.col("level")).alias("up"), "best")))
    per_message = settle(
        per_passage.groupBy("_row").agg(
            F.count(F.lit(1)).alias("n_quotes"), F.count("best").alias("n_linked"), shallow.alias("shallow")
        ),
        "quote-links",
    )
    replies = per_message.where("shallow is not null").select("_row", F.col("shallow.best._source._row").alias("_parent"))
    return replies, per_message.select("_row", "n_quotes", "n_linked")


def _threads(replies: DataFrame) -> DataFrame:
    """First message (``_root``) and depth of each reply, by doubling the length of the jumps."""
    jumps = settle(replies.select("_row", F.col("_parent").alias("_root"), F.lit(1).alias("depth")), "quote-jumps")
    while True:
        ahead = jumps.select(F.col("_row").alias("_root"), F.col("_root").alias("_far"), F.col("depth").alias("_more"))
        longer = settle(jumps.join(ahead, "_root", "left"), "quote-jumps")
        if longer.where("_far is not null").limit(1).count() == 0:
            return jumps
        jumps = longer.select(
            "_row",
            F.coalesce("_far", "_root").alias("_root"),
            (F.col("depth") + F.coalesce(F.col("_more"), F.lit(0))).alias("depth"),
        )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Messages of every conversation in reply order, with their own words only.

    Quoted passages (runs of lines of one level of ``>`` marks) are normalised (lower case, white space and line ends
    folded), hashed, and joined to the latest earlier message of the same conversation that holds the whole passage among
    its own words. Where none does, lines decide: the message that first said most of the passage, line by line. A
    message replies to what its shallowest linked passage quotes. Threads
    stand in the order of their first messages, the messages of a thread in the order of their turns, so a
    reply always follows what it answers.

    One row per message: ``conv_id, position`` (from 0), ``turn, role, reply_to`` and ``thread`` (turns),
    ``depth, n_quotes, n_linked`` (passages), ``text``. Null text: empty, quotes nothing. Null conversation:
    one of its own. Null turn: last. Equal turns are ordered by role and text; equal rows all stay, in an
    order that makes no difference. A quote that no earlier message said is removed, but links nothing.
    Empty table: no rows. Other columns are not read. A very long text takes space in proportion to its words, in the task
    that has it. A line that very many messages say has one original and passages are looked up once for all that quote them, so no pairs arise; positions come from distributed prefix sums, so a conversation may be of any size.
    """
    numbered_rows = numbered(messages.select("conv_id", "turn", "role", "text"), "quote-rows").select(
        "*",
        F.col("conv_id").isNull().alias("_no_conv"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv"),
        F.struct(
            F.col("turn").isNull().alias("late"),
            F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.xxhash64("text").alias("text"),
        ).alias("_at"),
    )
    # the number of messages that stand before, the same for those that stand at one place
    group = ["_no_conv", "_conv"]
    placed = running_sums(numbered_rows.select("_row", *group, "_at"), group, ["_at"], [], "quote-places")
    first = placed.groupBy(*group, "_at").agg(F.min("rows_before").alias("_pos"))
    rows = settle(numbered_rows.join(first, [*group, "_at"]), "quote-messages")
    replies, counts = _links(rows)
    threads = settle(_threads(replies).join(replies, "_row"), "quote-threads")
    places = rows.select(F.col("_row").alias("_other"), F.col("_at").alias("_other_at"), F.col("turn").alias("_other_turn"))
    named = (
        threads.join(places.withColumnRenamed("_other", "_root"), "_root")
        .withColumnsRenamed({"_other_at": "_root_at", "_other_turn": "thread"})
        .join(places.withColumnRenamed("_other", "_parent"), "_parent")
        .select("_row", "_root", "_root_at", "thread", "depth", F.col("_other_turn").alias("reply_to"))
    )
    linked = rows.drop("text").join(named, "_row", "left").join(counts, "_row", "left")
    ordered = running_sums(
        linked.select(
            "_row", "conv_id", "_no_conv", "_conv", "turn", "role", "reply_to", "_at",
            F.coalesce("_root_at", "_at").alias("_thread_at"),
            F.coalesce("_root", "_row").alias("_thread_row"),
            F.when(F.col("_root").isNull(), F.col("turn")).otherwise(F.col("thread")).alias("thread"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        ),
        ["_no_conv", "_conv"],
        ["_thread_at", "_thread_row", "_at", "_row"],
        [],
        "quote-order",
    )
    texts = rows.select("_row", unquoted_text(F.col("text")).alias("text"))
    return ordered.join(texts, "_row").select(
        "conv_id", F.col("rows_before").alias("position"), "turn", "role", "reply_to", "thread",
        "depth", "n_quotes", "n_linked", "text",
    )
