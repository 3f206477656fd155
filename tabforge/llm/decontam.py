"""Benchmark decontamination by template canonicalisation (operator 5).

Texts become templates: numbers, names and units are replaced by typed placeholders, other words lower-cased,
punctuation dropped. Windows of template tokens of all documents are hash-joined with those of the benchmark items, so
a question that was copied with other numbers or names still matches. A window has ``WINDOW`` tokens, or as many more
(``SIZES``) as it takes to hold ``MIN_LITERALS`` words that are no placeholders. A match lies on a diagonal, the
distance of the two positions; on each diagonal every value of the item must stand for one value of the document (slot
consistency), else its windows don't count.

Beside them, windows of plain lower-cased words are joined by equality. They find what templates cannot: windows that
are all placeholders, items of a few words, and copies in other case.

Every token is hashed once; hashes of windows come from those of their halves, and only their hashes are exploded. The
documents' windows meet the set of the items' window hashes first; what is left is joined with the items.

Only built-in DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import Stage, only, text_or_empty

WINDOW = 8
#: Tokens of a window: the first of these with words enough.
SIZES = (8, 12, 16, 24, 32)
#: Words that are not placeholders which a window of an item must hold to be searched as a template.
MIN_LITERALS = 5
#: An item is found if so many of its windows are, or half of them.
MIN_WINDOWS = 6
#: Items of fewer tokens are searched as plain words only.
SHORTEST = 4
#: Distinct window hashes of items up to which they are sent to every executor (32 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 1_000_000

#: A name is a capitalised word, or several, that don't begin a sentence: they follow a lower-case letter, a digit or a
#: comma, colon or semicolon and a blank. The blank stays with the token and marks it. Groups repeat possessively: the
#: others take a stack frame for each repetition, and names and numbers may have thousands.
TOKEN = (r"(?<=[\p{Ll}0-9,;:]) \p{Lu}\p{Ll}\p{L}*+(?: \p{Lu}\p{Ll}\p{L}*+)*+|[0-9]++(?:[.,][0-9]++)*+|\p{L}+"
         r"|(?<=[0-9])[%€£$°]|[$€£](?=[0-9])")
#: White space that is not one blank.
WIDE = r"[\s\p{Z}]{2,}|[\s\p{Z}&&[^ ]]"
NAME, NUMBER, UNIT = "\u0001name", "\u0001number", "\u0001unit"
# fixed values: units of measure and money
UNITS = ("% $ € £ ° mm cm km inch inches feet ft yards mile miles mg kg gram grams kilogram kilograms lb lbs pounds "
         "ounce ounces oz ml liter liters litre litres gallon gallons sec seconds min minutes hour hours days "
         "week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent degrees mph kmh hz khz mhz "
         "kw kwh kj cal kcal byte bytes kb mb gb tb").split()
#: Letters and common words that are units right after a number only.
UNITS_AFTER_NUMBER = "a g h j l m s v w day degree foot minute pound second yard".split()


def words_of(text: Column) -> Column:
    """Tokens as they stand in the text, white space taken as one blank."""
    return F.regexp_extract_all(F.regexp_replace(text, WIDE, " "), F.lit(TOKEN), F.lit(0))


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def lowered(words: Column) -> Column:
    return F.transform(words, lambda t: F.lower(F.ltrim(t)))


def template_of(words: Column, low: Column | None = None) -> Column:
    """``words`` and ``low``, its lower-cased tokens, are read by place: give columns that stand, not the expressions that
    make them."""
    def kind(t, i):
        x = F.lower(t) if low is None else F.get(low, i)
        unit = x.isin(UNITS + UNITS_AFTER_NUMBER) & (x.isin(UNITS) | _is_number(F.get(words, i - 1)))
        return F.when(t < "!", NAME).when(_is_number(t), NUMBER).when(unit, UNIT).otherwise(x)
    return F.transform(words, kind)


def plain_of(low: Column) -> Column:
    """The lower-cased words of lower-cased tokens: a name has one or more, other tokens are one; [''] if there is none."""
    return F.split(F.array_join(low, " "), " ")


def _plain(words: Column) -> Column:
    """For each token its lower-cased words: a name has one or more, other tokens are one."""
    return F.transform(words, lambda t: F.when(F.substring(t, 1, 1) == " ", F.split(F.lower(F.substring(t, 2, 1 << 30)), " "))
                       .otherwise(F.array(F.lower(t))))


def _halves(n: int) -> tuple[int, int]:
    """A window of ``n`` tokens is one of the largest power of two below ``n`` and the rest."""
    left = 1 << (n - 1).bit_length() - 1
    return left, n - left


def _with_hashes(df: DataFrame, tokens: str, name: str, seed: int, sizes: list[int]) -> DataFrame:
    """Adds arrays ``<name><size>``: the hashes of the windows of each size of the array ``tokens``, in order."""
    todo, todo_next = set(sizes), set(sizes)
    while todo_next:
        todo_next = {h for n in todo_next if n > 1 for h in _halves(n)} - todo
        todo |= todo_next
    for n in sorted(todo):
        if n == 1:
            h = F.transform(tokens, lambda t: F.xxhash64(F.lit(seed), t))
        else:
            left, right = _halves(n)
            h = F.expr(f"zip_with(slice({name}{left}, 1, greatest(size({tokens}) - {n - 1}, 0)), "
                       f"slice({name}{right}, {left + 1}, greatest(size({tokens}) - {n - 1}, 0)), (x, y) -> xxhash64(x, y))")
        df = df.withColumn(f"{name}{n}", h)
    return df


def _sizes(t: DataFrame) -> list[int]:
    return sorted(r["size"] for r in t.select("size").distinct().collect())  # SIZES and 1 to WINDOW - 1 at most


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> one row for each document and item found in it:
    doc_id, item_id, matched (distinct windows of the item's words that stand in the document, as plain words or in a
    template), windows (of the item's words), changed (values of the item that the document replaces by others),
    item_words.

    An item is found by half of its windows of plain words, by ``MIN_WINDOWS`` of them, or by half of its template
    windows, counting those that hold too few words to be searched. Null and empty texts have no windows.
    Items of fewer than ``window`` tokens are one window; those of fewer than ``SHORTEST`` are found word for word only,
    so an item of one word is found wherever that word stands. A null doc_id or item_id cannot be reported and is not
    searched. Repeated rows of a document or item count as one; equal items are all reported. Empty tables give an
    empty result; other columns are ignored.
    """
    st = Stage(spark, "decontamination")
    ladder = sorted({window, *[n for n in SIZES if n > window]})
    # the items' windows
    items = st.put("texts", benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct()
                   .select("item_id", words_of(F.col("text")).alias("w")))
    items = items.select("item_id", "w", template_of(F.col("w")).alias("t"), _plain(F.col("w")).alias("p"))
    items = st.put("tokens", items.withColumn("q", F.flatten("p")))
    few = f"size(filter(slice(t, i, n), x -> NOT x IN ('{NAME}', '{NUMBER}', '{UNIT}'))) >= least({MIN_LITERALS}, ceil(least(size(t), {window}) * {MIN_LITERALS} / {window}))"
    fits = f"get(filter(array({', '.join(map(str, ladder))}), n -> i + n - 1 <= size(t) AND {few}), 0)"
    cut = (items.where(F.size("t") >= SHORTEST)
           .select("item_id", "w", "t", "p", F.posexplode(F.expr(f"sequence(1, greatest(size(t) - {window} + 1, 1))")).alias("pos", "i"))
           .withColumn("size", F.expr(f"if(size(t) < {window}, if({few.replace('slice(t, i, n)', 't')}, size(t), NULL), {fits})")).where("size IS NOT NULL"))
    cut = (cut.withColumn("part", F.expr("slice(t, i, size)")).withColumn("values", F.expr("slice(w, i, size)"))
           .withColumn("slots", F.size(F.filter("part", lambda t: t.isin(NAME, NUMBER, UNIT))))
           # windows of plain words that lie in it
           .withColumn("low", F.size(F.flatten(F.expr("slice(p, 1, pos)"))))
           .withColumn("high", F.col("low") + F.greatest(F.size(F.flatten(F.expr("slice(p, i, size)"))) - window, F.lit(0))))
    typed = st.put("typed", cut.select("item_id", "pos", "size", "part", "values", "slots", "low", "high"))
    words = (items.withColumn("size", F.least(F.size("q"), F.lit(window))).where("size > 0")
             .select("item_id", "size", "q", F.posexplode(F.sequence(F.lit(1), F.size("q") - F.col("size") + 1)).alias("pos", "i")))
    plain = st.put("plain-words", words.select("item_id", "pos", "size", F.expr("slice(q, i, size)").alias("part")))

    def hashed(t, seed):
        """One window a row: its hash is that of the only window of its size."""
        n = _sizes(t)
        if not n:
            return t.withColumn("h", F.lit(0).cast("long"))
        made = _with_hashes(t, "part", "h", seed, n)
        pick = F.coalesce(*[F.when(F.col("size") == k, F.get(f"h{k}", F.lit(0))) for k in n])
        return made.select(*t.columns, pick.alias("h"))
    grams = st.put("items", hashed(typed, 0).dropDuplicates(["item_id", "pos", "h", "low", "high"]))
    plain = st.put("plain", hashed(plain, 1).select("item_id", "pos", "size", "h").distinct())
    totals = (plain.groupBy("item_id").agg(F.countDistinct("pos").alias("windows"))
              .join(items.groupBy("item_id").agg(F.max(F.greatest(F.size("t") - window + 1, F.lit(1))).alias("templates"), F.max(F.size("q")).alias("item_words")), "item_id"))
    if not _sizes(plain):
        return totals.select(F.lit(0).cast("long").alias("doc_id"), "item_id", F.lit(0).cast("long").alias("matched"), "windows",
                             F.lit(0).cast("long").alias("changed"), "item_words")

    # the documents' windows
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    made = rows.select("doc_id", words_of(F.col("text")).alias("w")).withColumn("low", lowered(F.col("w")))
    made = made.select("doc_id", template_of(F.col("w"), F.col("low")).alias("t"), plain_of(F.col("low")).alias("q"))
    made = _with_hashes(_with_hashes(made, "t", "t", 0, _sizes(grams)), "q", "q", 1, _sizes(plain))
    hashes = [F.col(f"t{n}") for n in _sizes(grams)] + [F.col(f"q{n}") for n in _sizes(plain)]
    keys = (grams.select("h", "item_id", "pos", "slots", F.lit(True).alias("typed"))
            .unionByName(plain.select("h", "item_id", "pos", F.lit(0).alias("slots"), F.lit(False).alias("typed"))))
    keys = st.put("keys", keys)
    known = st.put("known", keys.groupBy("h").agg((F.max("slots") > 0).alias("slotted")))
    known = F.broadcast(known) if known.count() <= BROADCAST_WINDOWS else known
    seen = (made.select("doc_id", F.explode(F.array(*hashes)).alias("hs")).select("doc_id", F.posexplode("hs").alias("at", "h")).join(known, "h")
            .select("doc_id", "h", F.when(F.col("slotted"), F.col("at")).alias("at")).distinct())  # places count where there are values
    hits = st.put("hits", st.put("seen", seen).join(keys, "h").select("doc_id", "item_id", "at", "pos", "slots", "h", "typed"))

    # values of the windows with placeholders, for each diagonal
    slotted = hits.where("slots > 0")
    again = only(rows, st.put("slotted", slotted.select("doc_id").distinct())).select("doc_id", words_of(F.col("text")).alias("mine"))
    again = again.withColumn("canon", template_of(F.col("mine")))
    pairs = (slotted.join(grams.select("item_id", "pos", "h", "part", "values", "size"), ["item_id", "pos", "h"]).join(again, "doc_id")
             .withColumn("own", F.expr("slice(mine, at + 1, size)"))
             .where(F.expr("slice(canon, at + 1, size)") == F.col("part"))  # of repeated rows, the one that the hit is in
             .select("doc_id", "item_id", (F.col("at") - F.col("pos")).alias("d"),
                     F.explode(F.arrays_zip("part", "values", "own")).alias("z"))
             .where(F.col("z.part").isin(NAME, NUMBER, UNIT))
             .groupBy("doc_id", "item_id", "d", F.col("z.part").alias("kind"), F.lower("z.values").alias("value"))
             .agg(F.min(F.lower("z.own")).alias("x"), F.max(F.lower("z.own")).alias("y")))
    slots = st.put("slots", pairs.groupBy("doc_id", "item_id", "d").agg(F.max((F.col("x") != F.col("y")).cast("int")).alias("torn"),
                                                                     F.sum((F.col("x") != F.col("value")).cast("int")).alias("changed")))
    checked = (hits.where("typed").withColumn("d", F.col("at") - F.col("pos")).join(slots, ["doc_id", "item_id", "d"], "left")
               .where("torn IS NULL OR torn = 0 OR slots = 0")
               .join(grams.select("item_id", "pos", "h", "low", "high"), ["item_id", "pos", "h"])
               .select("doc_id", "item_id", F.explode(F.sequence("low", "high")).alias("word"), F.col("pos").alias("template"), "changed"))
    exact = hits.where("NOT typed").select("doc_id", "item_id", F.col("pos").alias("word"), F.lit(None).cast("int").alias("template"),
                                           F.lit(None).cast("long").alias("changed"))
    found = (checked.unionByName(exact).groupBy("doc_id", "item_id")
             .agg(F.countDistinct("word").alias("matched"), F.countDistinct("template").alias("canonical"),
                  F.coalesce(F.max("changed"), F.lit(0)).alias("changed")).join(totals, "item_id"))
    return (found.where((F.col("matched") >= MIN_WINDOWS) | (2 * F.col("matched") >= F.col("windows")) | (2 * F.col("canonical") >= F.col("templates")))
            .select("doc_id", "item_id", "matched", "windows", F.col("changed").cast("long").alias("changed"), "item_words"))
