"""SpotSigs fingerprints, with DataFrame functions only.

Every common word (anchor) starts a chain of the next content words, whatever common words lie between; the chains of a
text are its signatures, and two texts are as alike as their signature sets (Jaccard). Content words behind the last
chain before the next common word can be covered too, by chains that end at content-defined words, so that all of a
text counts. Sets whose sizes differ too much cannot be alike, so near pairs are sought inside neighbouring partitions of set length, through the rarest signatures.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import running_total, text_or_empty
from lakemart.sources.lake import Workspace

CHAIN = 3
DIVISOR = 4
# Common words of English, French, German and Spanish, the anchors.
ANCHORS = tuple(
    sorted(
        set(
            "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their "
            "they this to was we were which who will with you "
            "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous ou par pas pour "
            "que qui sa se ses son sont sur un une vous "
            "aber als am auch auf aus bei bin das dem den der die ein eine einen einer es für hat ich im ist mit nach "
            "nicht noch sich sie sind so um und uns von vor war wie wir zu zum zur über "
            "al como con del donde el ella ellos entre era esta este fue ha hay las lo los más me mi muy nos o para "
            "pero por porque sin sobre su sus también te tiene una unos y ya".split()
        )
    )
)
_ANCHOR, _ANCHORED = "\x01", "\x01 "
_CUT = r"[^\p{L}\p{N}]+"


def signatures(text: Column, chain: int = CHAIN, cover: bool = False) -> Column:
    """Sorted distinct signatures of a text, as longs.

    Words are runs of letters and digits, lower-cased. The start of the text counts as an anchor. A text without
    content words has one signature, that of the whole text; an empty text has none. With ``cover``, the words of a
    stretch that no chain reaches (beyond ``chain`` words from the common word before) are cut behind every word whose
    hash leaves 0 by DIVISOR, and every part is one more signature: each content word is in some signature, and an
    edited word changes those of its own part only.
    """
    lower = F.lower(text)
    words = F.filter(F.split(lower, _CUT), lambda w: w != "")
    marked = F.transform(words, lambda w: F.when(w.isin(*ANCHORS), F.lit(_ANCHOR)).otherwise(w))
    joined = F.concat(F.lit(_ANCHOR), F.replace(F.array_join(marked, " "), F.lit(_ANCHORED), F.lit(_ANCHOR)))
    content = F.split(joined, " ")

    def chains(c: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.startswith(F.element_at(c, i), F.lit(_ANCHOR)))
        spelled = F.transform(places, lambda i: F.translate(F.array_join(F.slice(c, i, chain), " "), _ANCHOR, ""))
        return F.transform(F.filter(spelled, lambda s: s != ""), lambda s: F.xxhash64(s))

    def rest(stretch: Column) -> Column:
        beyond = F.slice(F.filter(F.split(stretch, " "), lambda w: w != ""), chain + 1, 1 << 30)
        ended = F.transform(beyond, lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(DIVISOR)) == 0, F.concat(w, F.lit(_ANCHOR))).otherwise(w))
        parts = F.transform(F.split(F.array_join(ended, " "), _ANCHOR), lambda s: F.trim(s))
        return F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.xxhash64(s))

    found = F.transform(F.array(content), chains)[0]
    if cover:
        found = F.concat(found, F.flatten(F.transform(F.split(joined, _ANCHOR), rest)))
    found = F.transform(F.array(found), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.xxhash64(lower))))[0]
    none = F.array().cast("array<long>")
    return F.when(F.length(text) == 0, none).otherwise(F.array_sort(F.array_distinct(found)))


def fingerprint(sigs: Column) -> Column:
    """A signature set as text: its size and the first half of its SHA-256."""
    digest = F.substring(F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256), 1, 32)
    return F.concat_ws(":", F.size(sigs).cast("string"), digest)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """late, id (and occurrence where ids repeat), text: columns that tell all rows apart and never are null."""
    rows = docs.select(
        F.col("doc_id").isNull().alias("late"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        text_or_empty().alias("text"),
    )
    if rows.groupBy("late", "id").count().where("count > 1").isEmpty():
        return rows, ["late", "id"]
    # Rows that share an id are few in any sane table; only their digests are ordered, equal ones are told apart by count.
    digest = F.xxhash64("text")
    same = rows.groupBy("late", "id", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", digest)
    spread = same.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return spread.select("late", "id", "digest", "copy", "text"), ["late", "id", "digest", "copy"]


def with_next(docs: DataFrame, work: Workspace, chain: int = CHAIN, cover: bool = False) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness; see ``edited``.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures for every row
    of ``docs`` (doc_id, text). The next document is that with the next smaller doc_id, after the smallest the largest;
    null doc_ids come last, rows with equal doc_id by digest. In a table of one row the next document is the row
    itself. Null texts count as empty; an empty table gives no rows; other columns are ignored. ``cover`` is that of
    ``signatures``.
    """
    rows, keys = _keyed(docs)
    order = ["late", "down", *keys[2:]]
    sizes = rows.select(*keys, F.bitwise_not("id").alias("down"), F.length("text").cast("long").alias("n"), F.lit(1).alias("one"))
    placed = running_total(sizes, order, "one", "place", work, "sizes")
    placed = work.save(placed.select(*keys, "n", "place"), "placed")
    total = placed.count()
    ahead = placed.select(F.pmod(F.col("place") + 1, F.lit(max(1, total))).alias("place"), *[F.col(k).alias(f"to_{k}") for k in keys],
                          F.floor(F.col("n") / 3).cast("int").alias("third"))
    wanted = work.save(placed.select(*keys, "place").join(ahead, "place").drop("place"), "wanted")
    lent = rows.join(wanted, keys).select(
        *[F.col(f"to_{k}").alias(k) for k in keys],
        F.substring(F.col("text"), F.lit(1), F.col("third")).alias("head"),
        F.col("third").alias("third"),
        signatures(F.col("text"), chain, cover).alias("next_sigs"),
    )
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.col("third")), F.col("head"))
    both = rows.join(lent, keys).select(
        *keys, n.cast("long").alias("n_chars"), edited.alias("edited"), "next_sigs", signatures(F.col("text"), chain, cover).alias("sigs")
    )
    both = both.withColumn("edited_sigs", signatures(F.col("edited"), chain, cover))
    return both.select(
        F.when(~F.col("late"), F.col("id")).alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").cast("long").alias("n_signatures"),
    )


def near_pairs(docs: DataFrame, work: Workspace, threshold: float = 0.8, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """Links between different signature sets with likeness >= ``threshold``, and the members of every set.

    Returns (pairs: a, b, near) and (members: doc_id, class_id); class_id is the smallest doc_id with the same set, and
    a < b are class ids. Sets of length n lie in partition floor(log(n) / log(1 / threshold)), so alike sets lie in
    the same or neighbouring partitions; there, two sets meet through one of their n - ceil(threshold * n) + 1 rarest
    signatures, one of which alike sets must share. Empty texts have empty sets and no links; null doc_ids join no class.
    """
    drawn = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), signatures(text_or_empty(), chain).alias("sigs")
    )
    drawn = work.save(drawn.withColumn("print", fingerprint(F.col("sigs"))), "drawn")
    classes = drawn.groupBy("print").agg(F.min("doc_id").alias("class_id"))
    members = work.save(drawn.select("doc_id", "print").join(classes, "print").select("doc_id", "class_id"), "members")
    leaders = members.where("doc_id = class_id").distinct()
    sets = work.save(drawn.where(F.size("sigs") > 0).join(leaders, "doc_id", "left_semi").drop("print").distinct(), "sets")
    spread = sets.select("doc_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    seen = spread.groupBy("sig").agg(F.count(F.lit(1)).alias("seen"))
    ranked = spread.join(seen, "sig").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("seen", "sig"))).alias("by"))
    length = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1
    zone = F.floor(F.log(F.col("n")) / math.log(1 / threshold) + 1e-9)
    probes = ranked.select("doc_id", "n", zone.alias("zone"), F.explode(F.slice(F.col("by")["sig"], F.lit(1), length)).alias("sig"))
    probes = work.save(probes, "probes")
    small = probes.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.explode(F.array("zone", F.col("zone") + 1)).alias("zone"), "sig")
    large = probes.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), "zone", "sig")
    met = small.join(large, ["zone", "sig"]).where((F.col("nx") < F.col("ny")) | (F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    met = met.where(F.col("nx") >= F.lit(threshold) * F.col("ny") - 1e-9).select("x", "y").distinct()
    for side in ("x", "y"):
        met = met.join(sets.toDF(side, f"set_{side}"), side)
    near = met.select("x", "y", likeness(F.col("set_x"), F.col("set_y")).alias("near")).where(F.col("near") >= threshold)
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "near"), members
