"""Texts that look alike: one form, classes and pairs.

Mapping to Latin look-alikes, wide and narrow forms, ligatures and blanks runs as
built-in expressions inside the JVM (``translate`` and ``replace``); canonical
equivalence (accents as one or two code points) and ignorable characters are left
to the accent-sensitive Unicode collation under which SQL groups the mapped values.

So that copies and unrelated texts cost little, the grouping is staged:

1. every text gets a coarse key (the mapped text without accents, hashed); equal
   looks always have equal coarse keys. Texts are mapped once, and only their numbers
   (id, key, hash) are kept and shuffled, with map-side combining, to find the coarse keys
   under which more than one text stands;
2. only texts under those keys are read again, meet by coarse key, are reduced to one row
   per different text, and are grouped under the collation. Up to ``NEAR_ROWS`` ids of
   theirs are sent to the readers, beyond they are joined by shuffle;
3. each class takes as canonical member the smallest text by code points, and the
   members come back by a join on the class.

``classes`` gives one row per document with its class and its number of links, which copies
do not multiply. Pairs are formed between the different texts of a class first and get their
documents afterwards, so a text with very many copies meets its few variants only.

Defined cases: null, empty and blank texts are in no class of ``classes`` and no
pair; equal texts are one member; ties cannot arise (the smallest text is unique);
digits and signs raised, lowered, circled or stacked keep their difference;
documents with a null id are ignored.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

# Letters of other scripts whose usual glyph is that of a Latin letter.
CYRILLIC = dict(zip("аеіоѕсрухјԁһԛԝӏАВЕКМНОРСТХІЅЈУԚԜ", "aeioscpyxjdhqwlABEKMHOPCTXISJYQW"))
GREEK = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳ", "ovABEZHIKMNOPTYXcj"))
# Signs drawn alike.
SIGNS = {"‐": "-", "‑": "-", "μ": "µ", "Ω": "Ω", "K": "K", "Å": "Å", "∙": "·", "⋅": "·", "ʼ": "’"}
#: Characters that show nothing.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿︎️"
#: Ids and their numbers that are broadcast at most (24 bytes each).
NEAR_ROWS = 1_000_000
_FORMS = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>")


#: Conjoining Hangul letters after the first of a syllable; the coarse key keeps the first.
_VOWELS_AND_FINALS = re.compile("[\u1161-\u11ff\ud7b0-\ud7fb]")


def _typographic(c: str) -> str | None:
    """The plain form of a wide, narrow or other typographic form of ``c``."""
    d = unicodedata.decomposition(c)
    if not d.startswith(_FORMS):
        return None
    plain = unicodedata.normalize("NFKC", c)
    if d.startswith("<compat>"):
        # ligatures and letter forms count, abbreviating signs (such as an ellipsis) are drawn differently
        if unicodedata.category(c) == "Zs":
            return " "
        if not unicodedata.category(c).startswith("L") or not plain.isalpha():
            return None
    return plain


def tables() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """(one-to-one map, one-to-many map, accent map) over all characters that have another form."""
    single: dict[str, str] = {c: "" for c in INVISIBLE}
    multi: dict[str, str] = {}
    accents: dict[str, str] = {}
    # beyond the first two planes only the compatibility ideographs have other forms
    for n in (*range(0x80, 0x20000), *range(0x2F800, 0x2FA20)):
        c = chr(n)
        if 0xD800 <= n < 0xE000 or c in single:
            continue
        if _VOWELS_AND_FINALS.fullmatch(c):
            accents[c] = ""
            continue
        if (p := _typographic(c)) is not None and p != c:
            (single if len(p) == 1 else multi)[c] = p
        elif unicodedata.category(c) == "Zs":
            single[c] = " "
        elif unicodedata.category(c) in ("Mn", "Me"):
            accents[c] = ""
        else:
            base = unicodedata.normalize("NFD", c)
            if len(base) > 1 and (unicodedata.combining(base[1]) or 0xAC00 <= n < 0xD7A4):
                accents[c] = base[0]
            elif len(base) == 1 and base != c:
                single[c] = base
    for extra in (CYRILLIC, GREEK, SIGNS):
        single.update({k: v for k, v in extra.items() if k != v})
    chain = lambda v: single.get(v, v)
    single = {k: chain(v) for k, v in single.items()}
    # composed letters go with the letter that they are composed on
    for c, v in accents.items():
        base = unicodedata.normalize("NFD", c)
        if v in single and len(base) > 1:
            whole = unicodedata.normalize("NFC", single[v] + base[1:])
            (single if len(whole) == 1 else multi)[c] = whole
    accents = {k: chain(v) for k, v in accents.items()}
    return single, multi, accents


_SINGLE, _MULTI, _ACCENTS = tables()
_COARSE = {k: _ACCENTS.get(v, v) for k, v in (_SINGLE | _ACCENTS).items()}


def _translate(col: Column, table: dict[str, str]) -> Column:
    gone = [k for k, v in table.items() if not v]
    kept = [(k, v) for k, v in table.items() if v]
    return F.translate(col, "".join(k for k, _ in kept) + "".join(gone), "".join(v for _, v in kept))


def line_ends(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _plain(col: Column) -> Column:
    """Only ASCII: as many bytes as characters. Such texts map to themselves."""
    return F.octet_length(col) == F.length(col)


def _several(col: Column) -> Column:
    """Characters that stand for several are written out; a text without any is only scanned."""
    found = F.length(F.translate(col, "".join(_MULTI), "")) < F.length(col)
    forms = F.array(*[F.struct(F.lit(k).alias("c"), F.lit(v).alias("v")) for k, v in _MULTI.items()])
    return F.when(found, F.aggregate(forms, col, lambda text, x: F.replace(text, x["c"], x["v"]))).otherwise(col)


def _mapped(col: Column, table: dict[str, str]) -> Column:
    return line_ends(F.when(_plain(col), col).otherwise(_translate(_several(col), table)))


def mapped(col: Column) -> Column:
    """``col`` with look-alike letters, forms and blanks mapped; accents stay as they are."""
    return _mapped(col, _SINGLE)


def coarse(col: Column) -> Column:
    """``mapped`` and without accents: equal for all texts that look alike."""
    return _mapped(col, _COARSE)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (
        df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where(F.col("id").isNotNull() & F.col("text").rlike(r"(?U)[^\s\x{200b}-\x{200d}\x{2060}\x{feff}]"))
        .withColumn("key", F.xxhash64(coarse(F.col("text"))))
        .withColumn("raw", F.xxhash64(F.col("text")))
    )


def _contested(keyed: DataFrame) -> DataFrame:
    """Coarse keys under which different texts stand."""
    return (
        keyed.groupBy("key")
        .agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("key")
    )


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (checkpointed numbers) marked for broadcast if it has no more than NEAR_ROWS rows."""
    return F.broadcast(df) if rows <= NEAR_ROWS else df


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, texts) of the classes with more than one text.

    members: id, key, raw; texts: key, raw, class (the canonical text's ``raw``), canonical.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = cut_lineage(_keyed(texts, "id", "text").select("id", "key", "raw"))
    members = cut_lineage(keyed.join(_contested(keyed), "key", "left_semi"))
    near = texts.join(_sized(members, members.count()), "id").where(F.xxhash64("text") == F.col("raw"))
    look = F.collate(mapped(F.col("text")), "UNICODE")
    different = near.groupBy("key", "raw").agg(F.first("text").alias("text")).withColumn("look", look)
    classes = (
        different.groupBy("key", "look")
        .agg(F.min(F.struct("text", "raw")).alias("least"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("key", "look", F.col("least.raw").alias("class"), F.col("least.text").alias("canonical"))
    )
    joined = different.join(classes, ["key", "look"]).select("key", "raw", "class", "canonical")
    return members, cut_lineage(joined)


def pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b): documents that look alike and differ in code points."""
    members, texts = variants(df, id_col, text_col)
    t = texts.select("key", "class", "raw")
    facing = (
        t.withColumnRenamed("raw", "raw_a")
        .join(t.withColumnRenamed("raw", "raw_b"), ["key", "class"])
        .where(F.col("raw_a") < F.col("raw_b"))
        .select("key", "raw_a", "raw_b")
    )
    a = members.select("key", F.col("raw").alias("raw_a"), F.col("id").alias("x"))
    b = members.select("key", F.col("raw").alias("raw_b"), F.col("id").alias("y"))
    return (
        facing.join(a, ["key", "raw_a"])
        .join(b, ["key", "raw_b"])
        .select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
        .where(F.col("id_a") != F.col("id_b"))
        .distinct()
    )


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class, links): each document in a class, the class' smallest id, and the documents of another text in it."""
    members, texts = variants(df, id_col, text_col)
    held = members.distinct().join(texts.select("key", "raw", "class"), ["key", "raw"])
    alike = held.groupBy("key", "class", "raw").agg(F.count("*").alias("same"), F.min("id").alias("least"))
    whole = alike.groupBy("key", "class").agg(F.sum("same").alias("all"), F.min("least").alias("least"))
    links = alike.select("key", "class", "raw", "same").join(whole, ["key", "class"])
    numbers = links.select("key", "class", "raw", F.col("least").alias("first"), (F.col("all") - F.col("same")).alias("links"))
    return held.join(numbers, ["key", "class", "raw"]).select("id", F.col("first").alias("class"), "links")


def canonical_members(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, canonical): every document with its class' canonical text; a document without look-alikes keeps its own text."""
    members, texts = variants(df, id_col, text_col)
    held = members.join(texts.select("key", "raw", "class", "canonical"), ["key", "raw"])
    other = held.where(F.col("raw") != F.col("class")).select("id", F.col("raw"), "canonical").distinct()
    all_ = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    return all_.withColumn("raw", F.xxhash64("text")).join(other, ["id", "raw"], "left").select("id", F.coalesce("canonical", "text").alias("canonical"))
