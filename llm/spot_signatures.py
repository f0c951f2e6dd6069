"""SpotSigs fingerprints, with DataFrame operations only.

A signature is an anchor, a very common word, and the content words that follow it, common words
skipped. Anchors are the words in the most documents of each language of the corpus and a built-in
list. Chains also start with the text, its lines, sentences and cells, and at one content word in
``STARTS``, chosen by its hash, so texts without anchors have signatures too, and an edit changes
only the chains that it touches. A document's fingerprint stands for the set of its signatures and
depends on the anchors: keep the list that :func:`corpus_anchors` returns to compare fingerprints of
different corpora. Sets are compared by Jaccard, in :func:`near_pairs` within and between
neighbouring length partitions.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import text_or_empty
from shelf.staging import stage

# Common words of English, German, French and Spanish, for corpora too small to have their own.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "das dem den der des die ein eine im ist mit nicht sich und von zu "
    "au aux dans du en est et la le les ou par pas pour que qui sur un une "
    "con del el los las no por se su una y"
).split()
CHAIN, STARTS = 2, 4
_MARK, _ENDS = "¶", "\n\r\t.!?;|。！？；"
_SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
_TOKEN = rf"[a-z0-9[\p{{L}}\p{{N}}&&[^{_SINGLE}]]]+|{_MARK}|[{_SINGLE}]"
#: Rows of a range of neighbouring ids, on average; the most ranges; rows drawn for each range.
RANGE_ROWS, MOST_RANGES, DRAWN = 2048, 1 << 14, 16


def _words(text: Column) -> Column:
    """Words in lower case; marks where lines, cells and sentences end; Han characters one by one."""
    marked = F.translate(F.lower(text), _ENDS, _MARK * len(_ENDS))
    return F.regexp_extract_all(marked, F.lit(_TOKEN), 0)


def word_hash(word: str) -> int:
    """What xxhash64 gives for a word, as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(word.encode(), 42)).astype(np.int64))


def corpus_anchors(docs: DataFrame, per_language: int = 25, share: float = 0.2, languages: int = 200) -> list[str]:
    """The built-in anchors and the commonest words of each language (column ``lang``, if there is one).

    Up to ``per_language`` words that at least ``share`` of the language's documents have, ten at
    least, anywhere in their texts; for the ``languages`` with the most documents.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    heads = docs.select(lang.alias("lang"), F.array_distinct(_words(text_or_empty())).alias("words"))
    # The word null counts the documents.
    rows = heads.select("lang", F.explode(F.concat(F.array(F.lit(None).cast("string")), "words")).alias("word"))
    counts = rows.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.where((F.col("n") >= 10) & (F.col("word").isNull() | ~F.col("word").isin("", _MARK))), "anchor-counts")
    total = counts.where("word is null").select(F.col("lang").alias("of"), F.col("n").alias("docs"))
    total = total.orderBy(F.desc("docs"), "of").limit(languages)
    common = counts.where("word is not null").join(F.broadcast(total), F.col("lang").eqNullSafe(F.col("of")))
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = common.where(F.col("n") >= F.col("docs") * share).withColumn("place", F.row_number().over(ranked))
    found = common.where(F.col("place") <= per_language).select("word").distinct().collect()
    return sorted({*ANCHORS, *(r["word"] for r in found)})


def signatures(text: Column, chain: int = CHAIN, anchors: list[str] = ANCHORS) -> Column:
    """The sorted distinct 64-bit signatures of ``text``; null counts as empty.

    A signature is the hash of a start and ``chain`` content words, fewer at the end of the text. The
    start is the anchor or mark right before the first word, else a sign of its own for the text's
    first word and for words whose hash is a multiple of ``STARTS``. A text without content words is
    its own signature; an empty text has none.
    """
    text = F.coalesce(text, F.lit(""))
    mark, first, drawn = (word_hash(x) for x in (_MARK, "^", "~"))
    skipped = sorted({mark, *map(word_hash, anchors)})
    words = F.transform(_words(text), lambda w: F.xxhash64(w))
    before = F.concat(F.array(F.lit(first)), words)

    def link(w: Column, p: Column) -> Column:
        """A content word, and its hash with its start, null where no chain starts."""
        start = F.when(p.isin([*skipped, first]), p).when(F.pmod(w, F.lit(STARTS)) == 0, F.lit(drawn))
        return F.when(w.isNotNull() & ~w.isin(skipped), F.struct(F.when(start.isNotNull(), F.xxhash64(start, w)).alias("h"), w.alias("w")))

    content = F.filter(F.zip_with(words, before, link), lambda x: x.isNotNull())

    def chained(links: Column) -> Column:
        grown = links
        for i in range(1, chain):
            later = F.slice(links, i + 1, F.greatest(F.size(links), F.lit(1)))
            grown = F.zip_with(grown, later, lambda x, y: F.struct(
                F.when(x["h"].isNotNull(), F.xxhash64(x["h"], y["w"])).alias("h")
            ))
        started = F.filter(grown, lambda x: x["h"].isNotNull())
        return F.array_sort(F.array_distinct(F.transform(started, lambda x: x["h"])))

    # An array of one binds its member, so that it is made once and not at every mention.
    found = F.transform(F.array(content), chained)
    return F.transform(
        found, lambda signs: F.when((F.size(signs) == 0) & (text != ""), F.array(F.xxhash64(text))).otherwise(signs)
    )[0]


def fingerprint(found: Column) -> Column:
    """A short name of a set of signatures: its length and a digest of the sorted members."""
    return F.concat(F.size(found).cast("string"), F.lit(":"), F.sha2(F.array_join(found.cast("array<string>"), ","), 256))


def likeness(a: Column, b: Column, bound: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets, 0 where their lengths rule out ``bound``.

    Two empty sets are alike (1); an empty and another set are not (0).
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    met = F.size(F.array_intersect(a, b))
    exact = F.when(large == 0, 1.0).otherwise(met / (F.size(a) + F.size(b) - met))
    return F.when(small < large * bound, 0.0).otherwise(exact).cast("double")


def in_ranges(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text, range, sentinel: rows by ranges of neighbouring documents in ascending doc_id.

    A row of a range besides its own, the sentinel, is the first row of the next range (of the first
    after the last), so each row finds its successor inside its range. Null ids come first; rows that
    share an id are ordered by hashes of text and place. The borders are rows of a sample (``DRAWN``
    rows for each range, ``MOST_RANGES`` ranges at most); it decides how even the ranges are.
    """
    order = F.struct("doc_id", "hash", "place")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("hash"), F.xxhash64(F.monotonically_increasing_id()).alias("place")
    )
    total = docs.count()
    share = min(DRAWN / RANGE_ROWS, DRAWN * MOST_RANGES / max(1, total))
    drawn = stage(rows.where(F.pmod(F.xxhash64("doc_id", "place"), F.lit(1 << 40)) < int(share * (1 << 40))), "drawn-borders")
    keys = drawn.orderBy("doc_id", "hash", "place").select("doc_id", "hash", "place").limit(2 * DRAWN * MOST_RANGES)
    borders = [tuple(r) for r in keys.collect()][DRAWN // 2 :: DRAWN]
    step = max(1, math.isqrt(len(borders)))
    groups = [borders[k : k + step] for k in range(0, len(borders), step)]
    key = "struct<doc_id: bigint, hash: bigint, place: bigint>"
    session = docs.sparkSession
    table = session.createDataFrame([([g[0] for g in groups], groups)], f"heads array<{key}>, groups array<array<{key}>>")

    def upto(borders: str) -> Column:
        return F.size(F.filter(F.col(borders), lambda b: b <= order))

    # Ranges are numbered by the borders up to a row: whole groups first, then within one.
    ranged = rows.withColumn("heads", table.select("heads").scalar()).withColumn("group", upto("heads"))
    ranged = ranged.withColumn("groups", table.select("groups").scalar()).withColumn(
        "inside", F.try_element_at("groups", F.greatest("group", F.lit(1)))
    )
    place = F.when(F.col("group") == 0, 0).otherwise((F.col("group") - 1) * step + upto("inside"))
    ranged = ranged.withColumn("range", place).select(*rows.columns, "range", F.lit(False).alias("sentinel"))
    least = docs.agg(F.min("doc_id").cast("long").alias("least"), F.count("doc_id").alias("named")).first()
    lowest = least["least"] if least["named"] == total else None
    first = rows.where(F.col("doc_id").eqNullSafe(F.lit(lowest))).orderBy("doc_id", "hash", "place").limit(1)
    number = session.createDataFrame(
        [(*b, k) for k, b in enumerate(borders)], "own_id long, own_hash long, own_place long, range int"
    )
    opens = drawn.join(
        number, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash"))
        & (F.col("place") == F.col("own_place")),
    ).select("doc_id", "text", "hash", "place", "range")
    wraps = first.withColumn("range", F.lit(len(borders)))
    sentinels = opens.unionByName(wraps).withColumn("sentinel", F.lit(True))
    return ranged.unionByName(sentinels)


def compare_edits(docs: DataFrame, anchors: list[str] | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next one's are.

    ``anchors`` are those of :func:`corpus_anchors` if not given; they are looked up at once. The next
    document is that of ascending doc_id, after the last the first; a lone row follows itself. The
    edit replaces the last quarter of the code points by the first as many of the next text. A null
    text counts as empty; repeated rows stay; no rows give none.
    """
    anchors = corpus_anchors(docs) if anchors is None else list(anchors)
    inside = Window.partitionBy("range").orderBy("sentinel", "doc_id", "hash", "place")
    rows = in_ranges(docs).withColumn("next_text", F.lead("text").over(inside))
    # Each text is signed once; the window takes the next one's signatures from its row.
    own = rows.withColumn("own", signatures(F.col("text"), anchors=anchors))
    followed = own.withColumn("following", F.lead("own").over(inside)).where(~F.col("sentinel"))
    quarter = "cast(floor(length(text) / 4) as int)"
    edited = F.expr(f"concat(left(text, length(text) - {quarter}), left(next_text, {quarter}))")
    made = followed.select("doc_id", F.length("text").cast("long").alias("n_chars"), "own", "following", edited.alias("edited"))
    signed = made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "following",
        signatures(F.col("edited"), anchors=anchors).alias("changed"),
    )
    return signed.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8, anchors: list[str] = ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): similar fingerprints (a, b, likeness), and the fingerprint of each doc_id.

    Copies share a fingerprint and are compared once. Sets go to partitions by length, whose
    width keeps sets of likeness ``threshold`` in the same or neighbouring ones, and meet through
    their rarest signatures, of which two such sets share at least one. Only sets that meet are
    compared. Empty sets form no pairs.
    """
    signed = docs.select("doc_id", signatures(text_or_empty(), anchors=anchors).alias("signs"))
    members = stage(signed.select("doc_id", fingerprint(F.col("signs")).alias("fingerprint"), "signs"), "signed")
    sets = members.where("size(signs) > 0").groupBy("fingerprint").agg(F.first("signs").alias("signs"))
    sets = stage(sets.withColumn("n", F.size("signs")), "sign-sets")
    signs = sets.select("fingerprint", "n", F.explode("signs").alias("sign"))
    common = signs.groupBy("sign").agg(F.count("*").alias("docs"))
    ranked = Window.partitionBy("fingerprint").orderBy("docs", "sign")
    needed = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    rare = signs.join(common, "sign").withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= needed)
    part = F.floor(F.log(F.col("n")) / -math.log(threshold) + 1e-9).cast("int")
    rare = rare.select("fingerprint", "n", "sign", part.alias("part"))
    near = rare.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    a, b = rare.alias("a"), near.alias("b")
    met = a.join(b, (F.col("a.sign") == F.col("b.sign")) & (F.col("a.part") == F.col("b.part")) & (
        (F.col("b.n") < F.col("a.n")) | (F.col("b.n") == F.col("a.n")) & (F.col("a.fingerprint") < F.col("b.fingerprint"))
    ) & (F.col("b.n") >= F.col("a.n") * threshold)).select(
        F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b")
    ).distinct()
    full = met.join(sets.select(F.col("fingerprint").alias("a"), F.col("signs").alias("x")), "a").join(
        sets.select(F.col("fingerprint").alias("b"), F.col("signs").alias("y")), "b"
    )
    pairs = full.select("a", "b", likeness(F.col("x"), F.col("y"), threshold).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), members.select("doc_id", "fingerprint")
