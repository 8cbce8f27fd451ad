"""Near-duplicate lines out of all documents, by an exact set-similarity join.

A line is the set of its words: what blanks, tabs, carriage returns, vertical tabs
and form feeds leave, in lower case.  A line goes if an earlier line, in the order of
(doc_id, place in the text, hash of the row), has a Jaccard similarity of at least 4/5
with it; equal lines are the special case.  Lines without a word stay.  A row is told
by its doc_id and a hash of doc_id and text, so rows of one doc_id, or of none, have
lines of their own.

Method, in DataFrame operations only:

* Words are counted in 2^20 buckets over all lines.  The order of words is: rarest
  bucket first (by powers of two), then by hash.  The buckets bound what is broadcast;
  with many words to a bucket the order is less sharp, the result the same.
* Equal lines are collapsed to their first before anything else.
* Prefix filter: of a line's n words in that order, the first n - ceil(t n) + 1
  go into an index; two similar lines share one of them.  Words that occur once have
  no entry.  A frequent word has its entries together with each word behind it, up to
  one word more: lines that share two words or more share the first two there, so
  entries stay short where single words are common.
* Length and positional filter: the sizes, and what can still be common behind the
  place where two lines meet, must allow the similarity.
* Bitmap filter: 64 parities of word hashes; two sets differ in at least as many words
  as their parities do.
* Lines of a small entry are joined with each other.  In a large one each line is tested
  against the first; that decides the members of large groups with one pair an entry.
  Those that are left are joined with all earlier lines of their large entries.
* Jaccard is computed on the whole sets.  Sets are fetched only for lines of pairs that
  are left; a bitmap of constant size sieves lines before the shuffle.

Words are told apart by 57 bits of XXH64.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import staged

#: The least Jaccard similarity, as a fraction.
LEAST = (4, 5)
#: Words that occur 2^FREQUENT times or more are indexed together with another word.
FREQUENT = 7
#: Lines of an entry that are joined with each other at once.
SMALL = 256
#: What lies between words, beside the blank.
GAPS = "\t\x0b\x0c\r"

_BUCKETS = 20  # bits
_CODE_BITS = 57
_SIEVE_WORDS = 15  # bits: so many 64-bit words
_K_BITS = 7  # of an index entry; a greater place counts as the greatest, which only filters less

#: A line: its row and its number in the text.
_PLACE = ["doc_id", "at", "row"]


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1)


def row_hash() -> Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64("doc_id", "text")


def _lines(documents: DataFrame, rows: Column | None = None) -> DataFrame:
    """Lines in lower case that have a word; with a sieve of rows, of these alone."""
    text = F.translate(F.lower("text"), GAPS, " " * len(GAPS))
    # outer, or Catalyst would split each text twice: to see if there is anything, and again
    lines = F.posexplode_outer(F.split(text, "\n")).alias("at", "line")
    # hashed once a text, below the lines
    hashed = documents.select("doc_id", "text", row_hash().alias("row"))
    if rows is not None:
        hashed = hashed.where(passes(rows, F.col("row")))
    return hashed.select("doc_id", "row", lines).where(F.trim("line") != "")


def _hashed(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(_mask(_CODE_BITS))


def word_sets(line: str = "line") -> Column:
    """The hashes of the distinct words of a line."""
    return F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), _hashed))


def _table(rows: DataFrame, size: int, kind: str) -> Column:
    """A scalar array of ``size`` values from rows (at, value); 0 where there is none."""
    none = rows.sparkSession.range(size).select(F.col("id").alias("at"), F.lit(0).cast(kind).alias("value"))
    full = rows.select(F.col("at").cast("long"), F.col("value").cast(kind)).unionByName(none)
    full = full.groupBy("at").agg(F.max("value").alias("value"))
    return full.agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"]).scalar()


def rarity(lines: DataFrame) -> Column:
    """For each bucket of words the power of two below its number of occurrences."""
    words = lines.select(F.explode(F.split("line", " ")).alias("word")).where("word <> ''")
    counted = words.groupBy(_hashed(F.col("word")).bitwiseAND(_mask(_BUCKETS)).alias("at")).count()
    return _table(counted.select("at", F.floor(F.log2("count")).alias("value")), 1 << _BUCKETS, "tinyint")


def _ordered(classes: Column, line: str = "line") -> Column:
    """The distinct words of a line as sorted codes: class first, then hash."""

    def code(word: Column) -> Column:
        found = F.get(classes, F.xxhash64(word).bitwiseAND(_mask(_BUCKETS)).cast("int")).cast("long")
        return F.shiftleft(found, _CODE_BITS).bitwiseOR(_hashed(word))

    return F.sort_array(F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), code)))


def _parities(codes: Column) -> Column:
    """A bit for each of 64 classes of hashes: whether their number is odd."""

    def flipped(held: Column, code: Column) -> Column:
        # a shift goes by the lowest six bits
        return held.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.hash(code)))

    return F.aggregate(codes, F.lit(0).cast("long"), flipped)


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _prefix(n: Column) -> Column:
    """How many words of a line of n words are indexed."""
    num, den = LEAST
    return n - _ceil_div(n * num, den) + 1


def _entries(codes: Column, n: Column) -> Column:
    """The index entries of a line: a hash, and in the last bits the place of its first word.

    Of the codes only those of the prefix, and one more, are looked at.
    """
    prefix = _prefix(n)
    none = F.array().cast("array<bigint>")
    last = (1 << _K_BITS) - 1

    def entry(k: Column, code: Column) -> Column:
        return F.shiftleft(code, _K_BITS).bitwiseOR(F.least(k, F.lit(last)).cast("long"))

    def entries(code: Column, k: Column) -> Column:
        seen = F.shiftright(code, _CODE_BITS)
        behind = F.slice(codes, k + 2, prefix - k)
        both = F.transform(behind, lambda other: entry(k, F.xxhash64(code, other)))
        alone = F.array(entry(k, code))
        return F.when(seen < 1, none).when((seen < FREQUENT) | (n == 1), alone).otherwise(both)

    return F.flatten(F.transform(F.slice(codes, 1, prefix), entries))


def _posted(lines: DataFrame) -> DataFrame:
    """A row an index entry: code, k and the other columns."""
    others = [c for c in lines.columns if c != "codes"]
    rows = lines.select(*others, F.explode(_entries(F.col("codes"), F.col("n"))).alias("entry"))
    code, k = F.shiftright("entry", _K_BITS), F.col("entry").bitwiseAND(_mask(_K_BITS)).cast("int")
    return rows.select(*others, code.alias("code"), k.alias("k"))


def sieve(hashes: DataFrame) -> Column:
    """A bitmap, of constant size, of some hashes, a column named hash."""
    hashed = F.col("hash")
    word = F.shiftright(hashed, 6).bitwiseAND(_mask(_SIEVE_WORDS))
    place = hashed.bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    # every bit of a word is a row of its own until they are united
    rows = hashes.select(word.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("value"))
    none = hashes.sparkSession.range(1 << _SIEVE_WORDS)
    none = none.select(F.col("id").alias("at"), F.lit(0).cast("long").alias("value"))
    full = rows.unionByName(none).groupBy("at").agg(F.bit_or("value").alias("value"))
    return full.agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"]).scalar()


def passes(bitmap: Column, hashed: Column) -> Column:
    """False only for what is surely not among the hashes of the sieve."""
    word = F.get(bitmap, F.shiftright(hashed, 6).bitwiseAND(_mask(_SIEVE_WORDS)).cast("int"))
    place = hashed.bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftright", word, place).bitwiseAND(F.lit(1)) == 1


def _place_hash() -> Column:
    return F.xxhash64(*_PLACE)


def _same_place(other: str) -> Column:
    """The place is that of the other columns; rows without a doc_id have one too."""
    first, *rest = _PLACE
    same = F.col(first).eqNullSafe(F.col(f"{other}{first}"))
    for name in rest:
        same &= F.col(name) == F.col(f"{other}{name}")
    return same


def _renamed(df: DataFrame, side: str, kept: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c in kept else f"{side}{c}") for c in df.columns))


def _may_match() -> Column:
    """Length, positional and bitmap filter of two lines that meet at places k of their orders.

    y_open is the size of y, or 0 where no pair of y is wanted.
    """
    num, den = LEAST
    n, m = F.col("x_n"), F.col("y_n")
    lengths = (F.least(n, F.col("y_open")) * den) >= (F.greatest(n, m) * num)
    needed = _ceil_div((n + m) * num, num + den)
    left = F.least(n - F.col("x_k"), m - F.col("y_k"))
    differ = F.bit_count(F.col("x_odd").bitwiseXOR(F.col("y_odd")))
    return lengths & (left >= needed) & (differ <= n + m - 2 * needed)


def similar(x: Column, y: Column) -> Column:
    num, den = LEAST
    common = F.size(F.array_intersect(x, y))
    return common * (num + den) >= (F.size(x) + F.size(y)) * num


def _verified(pairs: DataFrame, first: DataFrame, documents: DataFrame) -> DataFrame:
    """The numbers of the later lines of the pairs (x_id, y_id) that are similar."""
    pairs = staged(pairs.select("x_id", "y_id").distinct(), "pairs")
    wanted = pairs.select(F.col("x_id").alias("id")).unionByName(pairs.select(F.col("y_id").alias("id"))).distinct()
    placed = staged(first.select("id", *_PLACE).join(wanted, "id", "left_semi"), "placed")
    # the texts of other rows are not split again
    lines = _lines(documents, sieve(placed.select(F.col("row").alias("hash"))))
    sieved = lines.where(passes(sieve(placed.select(_place_hash().alias("hash"))), _place_hash()))
    # equal rows have their lines in common: once each
    own = sieved.groupBy(*_PLACE).agg(F.any_value("line").alias("line"))
    own = own.join(_renamed(placed, "own_"), _same_place("own_"))
    own = staged(own.select(F.col("own_id").alias("id"), word_sets().alias("words")), "sets")
    both = pairs.join(_renamed(own, "x_"), "x_id").join(_renamed(own, "y_"), "y_id")
    both = both.where(similar(F.col("x_words"), F.col("y_words")))
    return staged(both.select(F.col("y_id").alias("id")).distinct(), "similar")


def _collapsed(lines: DataFrame) -> DataFrame:
    """The first of equal lines, how often it occurs, its size, parities and the codes of its prefix.

    Lines are numbered by their places, so that the lesser id is the earlier line.
    """
    by_text = [F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")]
    # each column used once, so that the table of classes goes into the expression, not the rows
    coded = lines.withColumn("classes", rarity(lines))
    coded = coded.select(*_PLACE, *by_text, _ordered(F.col("classes")).alias("codes"))
    n = F.size("codes")
    made = [n.alias("n"), _parities(F.col("codes")).alias("odd"), F.slice("codes", 1, _prefix(n) + 1).alias("codes")]
    coded = coded.select("a", "b", *_PLACE, *made)
    line = F.struct(*_PLACE, "n", "odd", "codes")
    first = coded.groupBy("a", "b").agg(F.min(line).alias("first"), F.count("*").alias("copies"))
    first = first.select("a", "b", "copies", "first.*")
    # tasks hold ascending ranges of places, and so do the numbers
    first = first.repartitionByRange(*_PLACE).sortWithinPartitions(*_PLACE)
    return staged(first.withColumn("id", F.monotonically_increasing_id()), "lines")


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, at, row): the places of the lines that go."""
    lines = _lines(documents)
    first = _collapsed(lines)
    columns = ["id", "n", "odd"]

    # small entries whole, large ones against their first line; one exchange serves both sides
    entry = Window.partitionBy("code")
    postings = _posted(first.select(*columns, "codes"))
    sizes = {"size": F.count("*").over(entry), "leads": F.col("id") == F.min("id").over(entry)}
    postings = postings.withColumns(sizes)
    x = _renamed(postings.where((F.col("size") <= SMALL) | F.col("leads")), "x_", ("code",))
    y = _renamed(postings.where("size > 1"), "y_", ("code",)).withColumn("y_open", F.col("y_n"))
    later = F.col("x_id") < F.col("y_id")
    # the first line of a large entry meets itself too, to name the entry
    large = (F.col("y_size") > SMALL) & F.col("x_leads") & F.col("y_leads")
    met = x.join(y, "code").where(large | (later & _may_match()))
    met = staged(met.select(F.when(large, F.col("code")).alias("large"), "x_id", "y_id"), "met")
    decided = _verified(met.where("large is null"), first, documents)
    gone = decided

    # the rest of large entries
    codes = met.where("large is not null").select(F.col("large").alias("code"))
    if not codes.isEmpty():
        marked = first.join(decided.select(F.col("id").alias("known_id")), F.col("id") == F.col("known_id"), "left")
        undecided = F.when(F.col("known_id").isNull(), F.col("n")).otherwise(0)
        rest = _posted(marked.select(*columns, undecided.alias("open"), "codes"))
        in_large = passes(sieve(codes.select(F.xxhash64("code").alias("hash"))), F.xxhash64("code"))
        rest = rest.where(in_large).join(codes.distinct(), "code", "left_semi")
        near = _renamed(rest, "x_", ("code",)).join(_renamed(rest, "y_", ("code",)), "code")
        gone = gone.unionByName(_verified(near.where(_may_match() & later), first, documents))

    near = first.select("id", *_PLACE).join(gone.distinct(), "id", "left_semi").select(*_PLACE)
    copies = first.where("copies > 1").select("a", "b", *(F.col(c).alias(f"first_{c}") for c in _PLACE))
    light = lines.select(*_PLACE, F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
    equal = light.join(copies, ["a", "b"]).where(~_same_place("first_")).select(*_PLACE)
    return near.unionByName(equal)


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with text less its repeated lines, and n_lines and n_removed.

    Columns of these two names are replaced, all others kept.  Null text has no
    lines and stays null; a text whose every line goes is empty.  Rows that repeat
    both doc_id and text count as one place and lose the same lines; rows that share
    a doc_id, or have none, with other texts lose only their own.  Null doc_ids come
    before all others; of lines at one place of one doc_id that of the lesser hash of
    the row comes first.  Lines of one word set, in any order or number, are similar.
    """
    documents = documents.drop("n_lines", "n_removed")
    gone = staged(repeated_lines(documents.select("doc_id", "text")).distinct(), "gone")
    by_row = gone.groupBy("doc_id", "row").agg(F.collect_list("at").alias("gone_at"))
    by_row = by_row.toDF("gone_id", "gone_row", "gone_at")
    row = row_hash()
    touched = passes(sieve(gone.select(F.col("row").alias("hash"))), row)
    none = F.array().cast("array<int>")
    own = (row == F.col("gone_row")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    joined = documents.where(touched).join(by_row, own, "left").drop("gone_id", "gone_row")
    joined = joined.withColumn("gone_at", F.coalesce("gone_at", none))
    split = F.split("text", "\n")
    kept = F.filter(split, lambda line, at: ~F.array_contains(F.col("gone_at"), at))
    n_lines = F.coalesce(F.size(split), F.lit(0))
    cleaned = joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(n_lines),
            "n_removed": F.size("gone_at"),
            "text": F.array_join(kept, "\n"),
        }
    ).drop("gone_at")
    same = documents.where(~touched).withColumns(
        {"n_lines": F.when(F.col("text").isNull(), 0).otherwise(n_lines), "n_removed": F.lit(0)}
    )
    return cleaned.unionByName(same)
