"""Benchmark decontamination by template canonicalisation (operator 8); DataFrame functions only.

A text becomes a sequence of lower-case words in which names (capitalised words),
numbers and the units behind numbers are typed
placeholders.  Every five-word window of the benchmark is hashed, as template and
as plain words; of the documents every ``stride``-th window is.  A window of
placeholders alone says nothing as a template and is hashed as plain words only;
instead the windows at both ends of a stretch of such windows are always hashed.  An item counts as leaked when at
least 0.8 of its windows stand in the document; such a document has enough
windows in a row that a window at every stride meets one of them (see
``stride_for``), so the sampled windows find all candidates.  The windows hash-join;
of the candidates every window is then joined with those of the item, and
each meeting place gives an alignment of document and item (several, if words were
inserted or left out), which is compared word by word over the whole item.  Slots that were filled with other
values (re-parameterised questions) must be filled consistently: one value of
the item, one value in the document, where the value of a name is its whole run of up
to five words.  A capitalised word that begins a sentence may be no name, so it
meets any name but is held to no consistency.  A name may have another number of
words: windows around it count when those that end and begin with it do.  Where all alignments together are not, those
count that can be added, most windows first, without a contradiction.

Items with equal templates are one class, named by its smallest item_id; each of
their distinct wordings is compared, and the best one gives the row of the class.
Benchmark windows and candidate documents are broadcast only when their stored
row count is within ``BROADCAST_ROWS`` rows of fixed width, the items' words
only within ``BROADCAST_BYTES``; beyond that the same joins shuffle.  Alignments that
put the same words beside an item are compared once.

Defined results: null and empty texts and items with fewer than five words
leak nothing; a row per leaking (doc_id, item class); rows repeated with one
doc_id and text give one row; a null doc_id is kept as null; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import drop_rows, store, who

WINDOW = 5
SIMILARITY = 0.8
MAX_STRIDE = 8
#: Rows (a few longs each, under 64 MB) up to which a side is broadcast.
BROADCAST_ROWS = 1_000_000
#: Measured bytes of the items' words up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Words on each side that may belong to the same name.
RUN = 2
# Markers of names, numbers, units and capitals at a sentence's start (private-use characters), and the units.
NAME, NUMBER, UNIT, START = "\ue000", "\ue001", "\ue002", "\ue003"
MARKERS = NAME + NUMBER + UNIT + START
UNITS = ("km cm mm m kg mg g ml l s ms min h km/h mph miles mile feet foot inches inch yards yard pounds pound lbs oz hours hour "
         "minutes minute seconds second days day weeks week months month years year dollars dollar euros euro cents cent percent "
         "degrees meters metres grams kilograms liters litres").split()


def let(value: Column, use) -> Column:
    """Bind an expression once for several uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _has_marker(value: Column) -> Column:
    return reduce(or_, (value.contains(m) for m in MARKERS))


def marked(text: Column) -> Column:
    """Words separated by single spaces; names, numbers and units carry their marker in front."""
    t = F.when(_has_marker(text), F.translate(text, MARKERS, "")).otherwise(F.coalesce(text, F.lit("")))
    # the lookbehinds stand behind the capital, so that they are tried at capitals only
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{Ll}\p{Nd},;] \p{Lu})\p{Ll}+", f"{NAME}$0")
    t = F.regexp_replace(t, rf"\p{{Lu}}(?<![\p{{L}}\p{{M}}\p{{Nd}}{NAME}]\p{{Lu}})\p{{Ll}}+", f"{START}$0")
    t = F.regexp_replace(t, r"\p{Nd}+(?:[.,]\p{Nd}+)*", f" {NUMBER}$0 ")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    t = F.regexp_replace(F.lower(t), rf"(?<=\p{{Nd}} ) ?({units})(?![\p{{L}}])", f" {UNIT}$1 ")
    # single spaces are no matches, as most places that match would be such
    t = F.regexp_replace(t, rf"[^\p{{L}}\p{{M}}\p{{Nd}}{MARKERS}., ]+|[.,](?!\p{{Nd}})|(?<!\p{{Nd}})[.,]", " ")
    return F.trim(F.regexp_replace(t, " {2,}", " "))


def template(marked_text: Column) -> Column:
    """A marked text with the values of its slots taken out."""
    return F.regexp_replace(F.replace(marked_text, F.lit(START), F.lit(NAME)), f"([{NAME}{NUMBER}{UNIT}])[^ ]*", "$1")


def words(joined: Column) -> Column:
    """The words of a text that ``marked`` or ``template`` gave."""
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def plain(marked_text: Column) -> Column:
    """A marked text without the markers."""
    return reduce(lambda t, marker: F.replace(t, F.lit(marker), F.lit("")), MARKERS, marked_text)


def window_starts(marked_text: Column, w: Column, step: int) -> Column:
    """0, step, ... as far as a whole window fits, and the windows next to those of placeholders alone."""
    last = F.size(w) - WINDOW
    every = F.sequence(F.lit(0), last, F.lit(step))
    if step > 1:
        slot = lambda x: x.substr(1, 1).isin(*MARKERS)
        only = F.filter(F.sequence(F.lit(0), last), lambda i: slot(F.element_at(w, i + WINDOW)) & F.forall(F.slice(w, i + 1, WINDOW), slot))
        ends = let(only, lambda o: F.filter(F.array_except(F.flatten(F.transform(o, lambda i: F.array(i - 1, i + 1))), o),
                                            lambda i: (i >= 0) & (i <= last)))
        every = F.when(marked_text.rlike(f"(?:^| )(?:[{MARKERS}][^ ]*(?: |$)){{{WINDOW}}}"), F.array_union(every, ends)).otherwise(every)
    return F.when(last >= 0, every).otherwise(F.array().cast("array<int>"))


def hashed_windows(marked_text: Column, step: int) -> Column:
    """Array of (pos, h) of the windows at every ``step`` words (see ``window_starts``): of the plain words, and of the template
    where that differs and holds a word."""
    slots = rf"(?:^| )(?:[{MARKERS}][^ ]*(?: |$)){{{WINDOW}}}"  # a window of placeholders alone

    def both(joined: Column, i: Column) -> Column:
        hashed = lambda v: F.struct(i.alias("pos"), F.xxhash64(v).alias("h"))
        worded = lambda x: (F.length(x) > 2 * WINDOW - 1) | (F.translate(x, MARKERS + " ", "") != "")
        return let(joined, lambda t: F.when(~_has_marker(t), F.array(hashed(t))).otherwise(let(template(t), lambda x: F.when(
            worded(x), F.array(hashed(x), hashed(plain(t)))).otherwise(F.array(hashed(plain(t)))))))

    def by_words(m: Column) -> Column:
        return let(words(m), lambda w: F.transform(window_starts(m, w, step), lambda i: both(F.array_join(F.slice(w, i + 1, WINDOW), " "), i)))

    def by_steps(m: Column) -> Column:
        """The same for windows at every step only, cut out of the text in one pass."""
        cut = rf"([^ ]++(?: [^ ]++){{{WINDOW - 1}}})(?: [^ ]++){{0,{step - WINDOW}}} ?"
        return F.transform(F.regexp_extract_all(m, F.lit(cut), 1), lambda t, k: both(t, k * step))

    if step < WINDOW:
        return let(marked_text, lambda m: F.flatten(by_words(m)))
    return let(marked_text, lambda m: F.flatten(F.when(m.rlike(slots), by_words(m)).otherwise(by_steps(m))))


def item_classes(benchmark: DataFrame) -> DataFrame:
    """Stored: per distinct wording of five words or more its words and template words, and item_id and copies of its class."""
    items = benchmark.select("item_id", marked(F.col("text")).alias("m")).withColumn("t", template(F.col("m")))
    one = items.groupBy("t").agg(F.min(F.struct(F.col("item_id").isNull(), "item_id")).alias("first"), F.count(F.lit(1)).alias("copies"))
    worded = items.select("t", "m").distinct().join(one, "t")
    return store(worded.select(F.col("first.item_id").alias("item_id"), "copies", words(F.col("m")).alias("item_words"), words(F.col("t")).alias("item_t"))
                 .filter(F.size("item_t") >= WINDOW), "decontaminate-items")


def stride_for(shortest: int) -> int:
    """Distance of the document windows that cannot step over a leaked item of ``shortest`` words or more.

    With at least 0.8 of n - 4 windows intact, the longest run of intact windows
    has ceil(0.8 (n - 4)) of them while an edit of an inner word would break more
    than a fifth (n < 29), and at least 8 above that.  An inserted word breaks four
    inner windows, so k of them need n - 4 >= 20 k and leave k + 1 runs of which
    the longest has at least (n - 4 - 4 k) / (k + 1) >= 16 k / (k + 1) >= 8 windows.
    """
    return max(1, min(MAX_STRIDE, -(-8 * (shortest - WINDOW + 1) // 10)))


def _sized(df: DataFrame) -> DataFrame:
    """A stored table of fixed-width rows, broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, item_id and how the item stands in the document, for every leak."""
    items = item_classes(benchmark)
    joined = F.octet_length(F.array_join("item_words", " ")) + 32 * F.size("item_words")  # of both arrays, an array holds 8 bytes more a word
    shortest, width = items.agg(F.min(F.size("item_t")), F.sum(2 * joined)).first()
    step = stride_for(shortest or WINDOW)
    numbered = items.withColumns({"item": F.xxhash64(F.array_join("item_t", " ")), "wording": F.xxhash64(F.array_join("item_words", " "))})
    in_items = store(numbered.select("item", F.explode(hashed_windows(F.array_join("item_words", " "), 1)).alias("w"))
                     .select("item", F.col("w.pos").alias("item_pos"), "w.h").distinct(), "decontaminate-windows")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def windows(of: DataFrame, every: int) -> DataFrame:
        return (of.select("doc_id", "text_hash", F.explode(hashed_windows(marked(F.col("text")), every)).alias("w"))
                .select("doc_id", "text_hash", "w.pos", "w.h"))

    pairs = store(windows(rows, step).join(_sized(in_items), "h").select("doc_id", "text_hash", "item").distinct(), "decontaminate-candidates")
    wanted = _sized(pairs.select(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text")).distinct())
    held = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_hash") == F.col("in_text")), "left_semi")
    met = (windows(held.dropDuplicates(["doc_id", "text_hash"]), 1).join(_sized(in_items), "h")
           .groupBy("doc_id", "text_hash", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(F.lit(1).alias("met")).drop("met"))
    places = store(met, "decontaminate-places")
    candidates = places.groupBy("doc_id", "text_hash", "item").agg(F.collect_set("shift").alias("shifts"))
    candidates = candidates.withColumnsRenamed({"doc_id": "in_doc", "text_hash": "in_text"})
    if places.count() <= BROADCAST_ROWS:
        candidates = F.broadcast(candidates)
    same = rows["doc_id"].eqNullSafe(candidates["in_doc"]) & (rows["text_hash"] == candidates["in_text"])
    worded = numbered.select("item", "wording", "item_id", "copies", "item_words", "item_t")
    both = (rows.join(candidates, same)
            .join(F.broadcast(worded) if (width or 0) <= BROADCAST_BYTES else worded, "item")
            .select("doc_id", "text_hash", "item", "wording", "item_id", "copies", "item_words", "item_t", "shifts",
                    words(marked(F.col("text"))).alias("doc_words"))
            .dropDuplicates(["doc_id", "text_hash", "item", "wording"]))
    # stored before it is filtered: a filter would be pushed through the comparison and repeat it for each column that it reads
    compared = store(compare(both, similarity), "decontaminate-compared")
    found = compared.filter((F.col("containment") >= similarity) & (F.col("consistent") | (F.col("literal") >= similarity)))
    told = [c for c in found.columns if c not in ("doc_id", "text_hash", "item", "wording")]
    best = F.struct("literal", "consistent", "containment", (-F.col("slots")).alias("order"), "wording")
    return (found.groupBy("doc_id", "text_hash", "item").agg(F.max_by(F.struct(*told), best).alias("best"))
            .select("doc_id", "text_hash", "best.*"))


def compare(aligned: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Compare items word by word with the documents at every alignment (shift) found; alignments with equal words count once."""
    n = F.size("item_t")
    named = lambda w: w.substr(1, 1).isin(NAME, START)
    kind = lambda w: F.when(named(w), NAME).when(w.substr(1, 1).isin(NUMBER, UNIT), w.substr(1, 1)).otherwise(w)
    blank = lambda k: F.array_repeat(F.lit(""), k)

    def value(w: Column, k: Column) -> Column:
        """What fills the slot at ``k`` of padded words: a name's run, else the word itself."""
        at = lambda d: F.element_at(w, k + (RUN + 1 + d))
        left, right, linked = [], [], [F.lit(True), F.lit(True)]
        for d in range(1, RUN + 1):  # a run goes back to a sentence's start and not beyond it
            linked = [linked[0] & at(1 - d).startswith(NAME) & named(at(-d)), linked[1] & at(d).startswith(NAME)]
            left.insert(0, F.when(linked[0], plain(at(-d))))
            right.append(F.when(linked[1], plain(at(d))))
        return F.when(named(at(0)), F.concat_ws(" ", *left, plain(at(0)), *right)).otherwise(plain(at(0)))

    def at(item: Column, doc: Column) -> Column:
        """Per word of the item: template equal, word equal, kind of slot, both values; ``item`` and ``doc`` are padded by RUN words."""
        def one(k: Column) -> Column:
            return let(F.struct(F.element_at(item, k + (RUN + 1)).alias("i"), F.element_at(doc, k + (RUN + 1)).alias("d")), lambda p: let(F.struct(
                kind(p.i).alias("kind"), (kind(p.i) == kind(p.d)).alias("alike"), (plain(p.i) == plain(p.d)).alias("literal"),
                (kind(p.i).isin(NAME, NUMBER, UNIT) & (kind(p.i) == kind(p.d)) & ~p.i.startswith(START) & ~p.d.startswith(START)).alias("slot")),
                lambda q: F.struct((q.alike | q.literal).alias("same"), q.literal.alias("literal"), q.kind.alias("kind"), q.slot.alias("slot"),
                                   F.when(q.slot, value(item, k)).alias("i"), F.when(q.slot, value(doc, k)).alias("d"),
                                   (q.alike & ~q.literal).alias("other"))))
        return F.transform(F.sequence(F.lit(0), n - 1), one)

    def whole(compared: Column, what: str) -> Column:
        """Starts of the item's windows in which every word agrees."""
        return F.filter(F.sequence(F.lit(0), n - WINDOW),
                        lambda s: F.forall(F.slice(compared, s + 1, WINDOW), lambda c: c[what]))

    def judged(piece: Column) -> Column:
        return let(at(F.col("item_pad"), F.split(piece, " ")), lambda c: let(whole(c, "same"), lambda w: F.struct(
            (-F.size(w)).alias("order"), piece.alias("piece"), w.alias("windows"), whole(c, "literal").alias("literal"),
            F.exists(c, lambda x: x.other).alias("other"),
            F.transform(F.filter(F.transform(c, lambda x, k: F.struct(x.alias("x"), k.alias("k"))),
                                 lambda z: z.x.slot & F.exists(w, lambda s: (z.k >= s) & (z.k < s + WINDOW))),
                        lambda z: F.struct(z.x.kind.alias("kind"), z.x.i.alias("i"), z.x.d.alias("d"))).alias("slots"))))

    beside = lambda padded, shift: F.array_join(F.slice(padded, shift + n + 1, n + 2 * RUN), " ")
    pieces = let(F.concat(blank(n + RUN), F.col("doc_words"), blank(n + RUN)),
                 lambda padded: F.array_distinct(F.transform("shifts", lambda shift: beside(padded, shift))))
    seen = (aligned.withColumns({"pieces": pieces, "item_pad": F.concat(blank(F.lit(RUN)), F.col("item_words"), blank(F.lit(RUN)))})
            .withColumn("found", F.transform("pieces", judged)))
    slots = F.array_distinct(F.flatten(F.transform("found", lambda f: f.slots)))
    agree = lambda s: F.size(F.array_distinct(F.transform(s, lambda x: F.struct(x.kind, x.i)))) == F.size(s)
    added = lambda taken, f: let(F.array_distinct(F.concat(taken.slots, f.slots)), lambda s: F.when(agree(s), F.struct(
        F.array_union(taken.windows, f.windows).alias("windows"), s.alias("slots"))).otherwise(taken))
    nothing = F.struct(F.array().cast("array<int>").alias("windows"), F.array().cast("array<struct<kind:string,i:string,d:string>>").alias("slots"))
    seen = (seen.withColumn("windows", F.array_distinct(F.flatten(F.transform("found", lambda f: f.windows))))
            .withColumn("literal_windows", F.array_distinct(F.flatten(F.transform("found", lambda f: f.literal))))
            .withColumn("slots", slots).withColumn("taken", F.aggregate(F.array_sort("found"), nothing, added)))
    def across(w: Column) -> Column:
        """``w`` and the windows that span a name of 1 to RUN + 1 words, of which those that end and begin with it are in ``w``."""
        def spanning(more: int) -> Column:
            def whole_name(c: Column) -> Column:
                later = [F.element_at("item_pad", c + (RUN + 1 + d)).startswith(NAME) for d in range(1, more + 1)]
                return reduce(and_, later, named(F.element_at("item_words", c + 1)))
            both = F.filter(F.sequence(F.lit(0), n - 1), lambda c: whole_name(c) & F.array_contains(w, c - (WINDOW - 1)) & F.array_contains(w, c + more))
            return F.flatten(F.transform(both, lambda c: F.sequence(c - (WINDOW - 2), c + (more - 1))))

        return reduce(F.array_union, map(spanning, range(RUN + 1)), w)

    seen = seen.withColumns({"windows": across(F.col("windows")), "taken": F.col("taken").withField("windows", across(F.col("taken.windows")))})
    all_windows = (n - WINDOW + 1).cast("double")
    seen = (seen.withColumn("part", ~agree(F.col("slots")) & (F.size("taken.windows") / all_windows >= similarity))
            .withColumns({"windows": F.when(F.col("part"), F.col("taken.windows")).otherwise(F.col("windows")),
                          "slots": F.when(F.col("part"), F.col("taken.slots")).otherwise(F.col("slots"))}))
    return seen.select(
        "doc_id", "text_hash", "item", "wording", "item_id", "copies", n.alias("item_words"),
        (F.size("windows") / all_windows).alias("containment"), (F.size("literal_windows") / all_windows).alias("literal"),
        F.size("slots").alias("slots"), agree(F.col("slots")).alias("consistent"),
        (F.exists("slots", lambda s: s.i != s.d) | F.exists("found", lambda f: f.other & (F.size(f.windows) > 0))).alias("reparameterised"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).drop("text_hash")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a benchmark item."""
    keys = {"__who": who(), "__text_hash": F.xxhash64("text")}
    found = leaks(docs, benchmark).select(who().alias("__who"), F.col("text_hash").alias("__text_hash"))
    return drop_rows(docs, keys, found)
