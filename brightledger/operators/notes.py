"""Notes of reports: splitting, merging, classifying, linking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.dictionary import best_of, found_words
from brightledger.functions.note_words import NO_SUBCATEGORY, NOTE_CATEGORIES, NOTE_SUBCATEGORIES


def split_notes(df: DataFrame, key: str, content: str) -> DataFrame:
    """Numbered notes of a text: ``note_number, title, body``; a title ends at the first colon or semicolon, else with its line."""
    parts = df.select(key, F.posexplode(F.split(content, r"(?m)(?=^\d+(?:\.\d+)*\.)")).alias("pos", "part"))
    numbered = parts.where(F.col("part").rlike(r"^\d+(?:\.\d+)*\."))
    number = F.regexp_extract("part", r"^(\d+)", 1).cast("int")
    rest = F.regexp_replace("part", r"^\d+(?:\.\d+)*\.\s*", "")
    first = F.regexp_extract(rest, r"^([^:;\n]*)", 1)
    body = F.regexp_replace(F.substring(rest, F.length(first) + F.lit(1), F.length(rest)), r"^[\s:;]+|\s+$", "")
    return numbered.select(key, "pos", number.alias("note_number"), F.trim(first).alias("title"), body.alias("body"))


def last_blocks(notes: DataFrame, key: str) -> DataFrame:
    """One note per number: the last of its text."""
    return notes.groupBy(key, "note_number").agg(F.max_by(F.struct("title", "body"), "pos").alias("n")).select(key, "note_number", "n.title", "n.body")


#: A numbered block: number, title up to a colon, text without digits up to the next number (fixed value).
BLOCK = r"(?s)(\d+)\.\s*([^:]+):\s*([^0-9]+?)(?=\d+\.|$)"


def note_blocks(df: DataFrame, key: str, content: str) -> DataFrame:
    """``(key, note_number, title, body)`` of the blocks ``n. title: text`` in a running text, one for each number.

    The last title of a number stands, with the text of its first block, for number 1 of its last. Numbers beyond an int are none.
    """
    groups = [F.regexp_extract_all(content, F.lit(BLOCK), i).alias(f"g{i}") for i in (1, 2, 3)]
    rows = df.select(key, *groups).select(key, F.posexplode(F.arrays_zip("g1", "g2", "g3")).alias("pos", "g"))
    blocks = rows.select(key, "pos", F.col("g.g1").try_cast("int").alias("note_number"), F.trim("g.g2").alias("title"), F.regexp_replace("g.g3", r"^\s+|\s+$", "").alias("body")).where("note_number is not null")
    texts = blocks.groupBy(key, "note_number", "title").agg(F.min_by("body", "pos").alias("first"), F.max_by("body", "pos").alias("last"), F.max("pos").alias("pos"))
    best = texts.groupBy(key, "note_number").agg(F.max(F.struct("pos", "title", "first", "last")).alias("b"))
    return best.select(key, "note_number", "b.title", F.when(F.col("note_number") > 1, F.col("b.first")).otherwise(F.col("b.last")).alias("body"))


def merge_notes(df: DataFrame, keys: Sequence[str], number: str, seq: str, content: str, joined: Sequence[int] = (2,), least: int = 20) -> DataFrame:
    """One note per key: some numbers join their parts in order, others keep the longest (the first of equals)."""
    kept = df.where(F.length(F.trim(content)) >= least)
    whole = F.col(number).isin(*joined)
    parts = F.array_sort(F.collect_list(F.when(whole, F.struct(F.col(seq).alias("s"), F.col(content).alias("c")))))
    longest = F.max(F.when(~whole, F.struct(F.length(content).alias("n"), (-F.col(seq)).alias("s"), F.col(content).alias("c"))))
    out = kept.groupBy(*keys, number).agg(parts.alias("__parts"), longest.alias("__longest"), F.count(F.lit(1)).alias("merged_sources"))
    text = F.coalesce("__longest.c", F.array_join(F.transform("__parts", lambda p: p["c"]), "\n\n"))
    n = F.col("merged_sources")
    quality = F.when(n > 10, "high").when(n > 5, "medium").when(n > 1, "low").otherwise("single")
    return out.select(*keys, number, text.alias("text"), "merged_sources", quality.alias("merge_quality"))


def classify(df: DataFrame, text: str, patterns: dict[str, Sequence[str]]) -> DataFrame:
    """Adds category, confidence (share of its patterns that occur) and keywords; ties and misses go to the earlier category."""
    scores = []
    for i, (name, words) in enumerate(patterns.items()):
        found = F.array_compact(F.array(*[F.when(F.col(text).contains(w), F.lit(w)) for w in words]))
        scores.append(F.struct(F.size(found).alias("hits"), F.lit(-i).alias("order"), F.lit(name).alias("category"), F.lit(len(words)).alias("of"), found.alias("keywords")))
    best = F.array_max(F.array(*scores))
    out = df.withColumn("__best", best)
    share = F.col("__best.hits") / F.col("__best.of")
    return out.withColumns({"category": F.col("__best.category"), "confidence": share, "keywords": F.col("__best.keywords")}).drop("__best")


def subclassify(df: DataFrame, text: str, patterns: dict[str, dict[str, Sequence[str]]], default: str = "기타") -> DataFrame:
    """Adds ``subcategory``: of the row's category, the one most of whose words occur, the earlier of equals; ``default`` if none does."""
    chosen = F.when(F.lit(False), "")
    for category, parts in patterns.items():
        scores = []
        for i, (name, words) in enumerate(parts.items()):
            hits = sum((F.when(F.col(text).contains(w), 1).otherwise(0) for w in words), F.lit(0))
            scores.append(F.struct(hits.alias("hits"), F.lit(-i).alias("order"), F.lit(name).alias("name")))
        best = F.array_max(F.array(*scores))
        chosen = chosen.when(F.col("category") == category, F.when(best["hits"] > 0, best["name"]).otherwise(default))
    return df.withColumn("subcategory", chosen.otherwise(default))


def category_names(df: DataFrame) -> DataFrame:
    """All categories and subcategories, each once."""
    names = df.select(F.explode(F.array_distinct(F.array("category", "subcategory"))).alias("note_category"))
    return names.where(F.col("note_category").isNotNull()).distinct()


def classification_summary(df: DataFrame, category: str, year: str, confidence: str) -> DataFrame:
    """Counts and confidence by category, by year, by both and in all."""
    return df.groupingSets([[category], [year], [category, year], []], category, year).agg(
        F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("n"), F.avg(confidence).alias("avg_confidence"),
        F.min(confidence).alias("min_confidence"), F.max(confidence).alias("max_confidence"),
    )


def merge_classified(notes: DataFrame, classes: DataFrame, keys: Sequence[str], seq: str, columns: Sequence[str]) -> DataFrame:
    """Notes with their latest class, and classes without a note: a full outer join on the keys."""
    latest = classes.groupBy(*keys).agg(F.max(F.struct(F.col(seq).alias("__s"), *columns)).alias("__c"))
    return notes.join(latest.select(*keys, *[F.col(f"__c.{c}").alias(c) for c in columns]), list(keys), "full")


def note_links(rows: DataFrame, notes: DataFrame, numbers: str, keys: Sequence[str]) -> DataFrame:
    """An edge from each row to each note that it names."""
    named = rows.withColumn("note_number", F.explode(numbers))
    return named.join(notes.select(*keys, "note_number").distinct(), [*keys, "note_number"])


def matched_names(refs: DataFrame, targets: DataFrame, key: str, clean: str, raw: str, target_id: str, name: str, original: str) -> DataFrame:
    """Each reference's target by clean or by raw name, the lowest id where several match: two equi joins, no OR.

    Targets of one name are one row, with their lowest id, before references meet them: a name that many references and many targets
    share makes a row for each reference, not one for each pair.
    """
    def lowest(column: str, as_: str) -> DataFrame:
        return targets.groupBy(key, F.col(column).alias(as_)).agg(F.min(target_id).alias(target_id))

    a = refs.join(lowest(name, clean), [key, clean])
    b = refs.join(lowest(original, raw), [key, raw])
    both = a.select(*refs.columns, target_id).unionByName(b.select(*refs.columns, target_id))
    return both.groupBy(*refs.columns).agg(F.min(target_id).alias(target_id))


def containing_names(items: DataFrame, names: DataFrame, item: str, name: str, gram: int = 16) -> DataFrame:
    """The first name, in order, that contains each item; items that none contains, and blank ones, have no row.

    A containment has no key, so names are indexed by their pieces of the lengths that items have, up to ``gram`` characters. An item of
    that length or less is a piece itself, so that finding it costs the same however many names there are. A longer one is looked up by
    the rarest of its own pieces, as a name that contains the item has all of them, and what is found is compared: equi joins, no pairs
    of everything. Each name is counted once for a piece, and matches are combined before they are shuffled. Pieces are many more than
    the names that they are estimated by, so no side of a join is broadcast; the lengths, of which there are ``gram`` at most, are one array.
    """
    wanted = items.select(F.col(item).alias("item")).where(F.trim("item") != "").distinct()
    # A small table of names makes many pieces: it is dealt to all parts, which an estimate of its size does not draw together.
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = names.select(F.col(name).alias("name")).where("name <> ''").repartition(parts, "name").distinct()

    def pieces(text: str, n: Column) -> Column:
        """The distinct pieces of ``n`` characters."""
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n)))

    lengths = wanted.agg(F.collect_set(F.least(F.lit(gram), F.length("item")))).scalar()
    sizes = indexed.select("name", lengths.alias("lengths")).select("name", F.explode("lengths").alias("n")).where(F.col("n") <= F.length("name"))
    every = sizes.select("name", F.explode(pieces("name", F.col("n"))).alias("piece"))
    postings = every.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first")).hint("merge")
    short = wanted.where(F.length("item") <= gram).join(postings, F.col("item") == F.col("piece")).select("item", F.col("first").alias("name"))
    own = wanted.where(F.length("item") > gram).select("item", F.explode(pieces("item", F.lit(gram))).alias("piece"))
    # A piece that no name has counts as none: its item is in no name.
    rarest = own.join(postings.select("piece", "n").hint("merge"), "piece", "left").groupBy("item").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
    whole = every.where(F.length("piece") == gram).hint("merge")
    found = rarest.where("r.n > 0").select("item", "r.piece").join(whole, "piece").where(F.col("name").contains(F.col("item")))
    long = found.groupBy("item").agg(F.min("name").alias("name"))
    return short.unionByName(long).select(F.col("item").alias(item), F.col("name").alias(name))


def classified(
    df: DataFrame, title: str | None, content: str, categories: dict[str, Sequence[str]] = NOTE_CATEGORIES,
    subcategories: dict[str, dict[str, Sequence[str]]] = NOTE_SUBCATEGORIES, default: str = NO_SUBCATEGORY,
) -> DataFrame:
    """Adds ``category, confidence, keywords, subcategory`` of notes by the words of their titles and contents, read once for all words.

    A category's confidence is the share of its words that occur; ties, and notes with no word at all, go to the first
    category. Of the category's own parts the one most of whose words occur is the subcategory, the first of equals; ``default``
    where none does or the category has no parts. A null title or content counts as empty.
    """
    words = [w for ws in categories.values() for w in ws] + [w for parts in subcategories.values() for ws in parts.values() for w in ws]
    # Missing texts are left out.
    text = F.concat_ws(" ", *([title] if title else []), content)
    found = df.withColumn("__found", found_words(text, words))
    best = found.withColumn("__best", best_of("__found", categories))
    part = F.when(F.lit(False), "")
    for category, parts in subcategories.items():
        own = best_of("__found", parts)
        part = part.when(F.col("__best.name") == category, F.when(own["hits"] > 0, own["name"]).otherwise(default))
    return best.withColumns({
        "category": F.col("__best.name"), "confidence": F.col("__best.hits") / F.col("__best.of"), "keywords": F.col("__best.words"), "subcategory": part.otherwise(default),
    }).drop("__found", "__best")
