"""Variant spellings of names: a symmetric-delete index on tokens and optimal assignment.

1. Every different name string is folded (case, accents, umlaut spellings), cut into
   full tokens, initials and particles, and, where its form says so, into family and
   given part.
2. Token statistics over all strings: how many strings hold a token, how often it stands
   as given and as family part in unambiguous forms.
3. Symmetric-delete index: each token is joined with the tokens that share one of its
   single deletions; pairs within one edit (also a swap of neighbours) remain, and a rare
   token takes its more frequent neighbour as canonical form.
4. Blocks: all strings of one canonical family token, and the spellings of one group
   (collaborations) by their own tokens. Strings of one block with the same given tokens
   are one class; only classes are compared.
5. Classes of one block are aligned: given tokens are assigned one to one at least total
   cost (Hungarian method, lists of any length), where equal, initial, abbreviated,
   mistyped and nickname forms meet and others conflict. Two classes are linked if their
   first names fit and no token of the shorter list is left in conflict; two well attested
   names that differ by one letter at the start stay apart.
6. Entities: the connected classes, where a class that has only initials joins the one
   person it can stand for, and stays by itself where it fits several.

Strings, tokens, classes and pairs are rows of DataFrames joined by key, so that a family
name of any size is split by adaptive execution; nothing is collected.

Defined cases: null and blank names and "et al." are no names; equal strings are one;
strings of one token are compared as whole tokens; very long strings are cut into tokens
whole; a pair is ordered by code point.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, in_arrow

# Usual short forms of given names.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander", "andi": "andreas", "andy": "andrew", "annie": "anna", "barb": "barbara", "becky": "rebecca",
    "bella": "isabel", "ben": "benjamin", "bernie": "bernard", "bert": "albert", "beth": "elizabeth", "bill": "william", "bob": "robert",
    "cathy": "catherine", "charlie": "charles", "chris": "christian", "dan": "daniel", "dave": "david", "debbie": "deborah",
    "dick": "richard", "dom": "dominik", "ed": "edward", "fred": "frederick", "gabe": "gabriel", "gene": "eugene", "greg": "gregory",
    "hal": "harald", "hanni": "johanna", "jake": "jacob", "jerry": "gerald", "jim": "james", "joe": "joseph", "jon": "jonathan",
    "judy": "judith", "kate": "katherine", "kathy": "katherine", "larry": "lawrence", "len": "leonard", "liz": "elizabeth",
    "lottie": "charlotte", "maggie": "margaret", "matt": "matthew", "meg": "margaret", "mel": "melanie", "mick": "michael",
    "mike": "michael", "nate": "nathaniel", "nick": "nicholas", "pat": "patricia", "patty": "patricia", "peggy": "margaret",
    "phil": "philip", "rob": "robert", "ron": "ronald", "sam": "samuel", "sandy": "sandra", "steffi": "stefanie", "steve": "stephen",
    "sue": "susanne", "susi": "susanne", "ted": "theodore", "theo": "theodore", "tim": "timothy", "toni": "anton", "tony": "anton",
    "vicky": "victoria", "will": "william",
}
PARTICLES = frozenset("van von der den de del della di da du la le dos ter ten zu zur vom af av".split())
GROUP_WORDS = frozenset("collaboration collab coll collaborations consortium group team project committee network the and of for".split())
_MIN_EDIT = 5
#: A token in more than FEW strings is another spelling only of one in so many times as many.
FEW, RARE_RATIO = 3, 8


def fold(s: str) -> str:
    """Lower case without accents."""
    s = unicodedata.normalize("NFKD", s).casefold()
    s = "".join(c for c in s if not unicodedata.combining(c))
    return s.replace("ø", "o").replace("ł", "l").replace("đ", "d")


def collapse(token: str) -> str:
    """Umlauts written with an e become plain letters."""
    return re.sub(r"(?<=[aou])e", "", token)


def parse(name: str) -> tuple[bool, list[str], list[str], str | None, list[str]]:
    """(is group, full tokens in order, initials in order, family token if the form tells it, tokens surely given)."""
    text = unicodedata.normalize("NFC", name)
    words = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text)
    low = [w.casefold() for w in words]
    if any(w in GROUP_WORDS and w not in ("the", "and", "of", "for") for w in low):
        return True, [fold(w) for w, x in zip(words, low) if x not in GROUP_WORDS], [], None, []
    head, comma, tail = text.partition(",")
    all_caps = text.upper() == text

    def split(part: str) -> tuple[list[str], list[str]]:
        full, ini = [], []
        for m in re.finditer(r"([^\W\d_]+(?:['’-][^\W\d_]+)*)(\.?)", part):
            w = m.group(1)
            last = not all_caps and w.isupper() and not re.search(r"[^\W\d_]", part[m.end() :])
            if w.casefold() in PARTICLES and not (last and full):  # "Rossi LE" ends with initials, "DE ROSSI" begins with a particle
                continue
            if len(w) == 1:
                ini.append(fold(w))
            elif len(w) <= 3 and w.isupper() and (not all_caps or not re.search(r"[AEIOUYÄÖÜ]", w)):
                ini.extend(fold(c) for c in w)
            else:
                full.append(fold(w))
        return full, ini

    if comma:
        (fam, fi), (giv, gi) = split(head), split(tail)
        return False, giv + fam, fi + gi, fam[-1] if fam else None, giv
    full, ini = split(text)
    if len(full) == 1:
        return False, full, ini, full[0], []
    first = re.match(r"\s*[^\W\d_]{2,}(?:['’-][^\W\d_]+)*\s+[^\W\d_]\b", text)
    if len(full) == 2 and ini and first:  # given, initial, family
        return False, full, ini, full[-1], full[:-1]
    return False, full, ini, None, []


def within_one_edit(a: str, b: str) -> bool:
    """One substitution, deletion, insertion or swap of neighbours at most."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def near(a: str, b: str) -> bool:
    """Two spellings of a token: one edit, in short tokens a swap, or another umlaut spelling."""
    ca, cb = collapse(a), collapse(b)
    if ca == cb:
        return True
    if max(len(a), len(b)) < _MIN_EDIT:
        return sorted(a) == sorted(b) and within_one_edit(a, b)
    return within_one_edit(a, b) or within_one_edit(ca, cb)


def cost(a: str, b: str) -> float | None:
    """Cost of setting two given tokens equal, None if they conflict."""
    if a == b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.2 if a[0] == b[0] else None
    if min(len(a), len(b)) >= 3 and (a.startswith(b) or b.startswith(a)):
        return 0.4  # an abbreviation
    if near(a, b) or (min(len(a), len(b)) >= 4 and within_one_edit(a, b)):
        return 0.6
    return None


_CONFLICT = 1e6


def least_assignment(costs: list[list[float]]) -> float:
    """Least total of assigning every row of ``costs`` to a column of its own (rows <= columns)."""
    n, m = len(costs), len(costs[0]) if costs else 0
    u, v, row_of, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], j0 = i, 0
        least, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while row_of[j0]:
            used[j0] = True
            i0, delta, j1 = row_of[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    cur = costs[i0 - 1][j - 1] - u[i0] - v[j]
                    if cur < least[j]:
                        least[j], way[j] = cur, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[row_of[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            row_of[j0] = row_of[way[j0]]
            j0 = way[j0]
    return sum(costs[row_of[j] - 1][j - 1] for j in range(1, m + 1) if row_of[j])


def assign(a: list[str], b: list[str]) -> float | None:
    """Least cost of assigning the shorter list's tokens into the longer; None if any conflicts."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0
    costs = [[_CONFLICT if (c := cost(x, y)) is None else c + 0.05 * (k != i) for k, y in enumerate(b)] for i, x in enumerate(a)]
    total = least_assignment(costs)
    return total if total < _CONFLICT else None


def same(given_a: list[str], given_b: list[str]) -> bool:
    """Given parts fit: the first names, which begin alike, and what else both name; a bare family name fits its like only."""
    if not given_a or not given_b or given_a == given_b:
        return given_a == given_b
    x, y = given_a[0], given_b[0]
    return x[0] == y[0] and cost(x, y) is not None and assign(given_a, given_b) is not None


def fits(given_a: list[str], own_a: list[str], given_b: list[str], own_b: list[str]) -> bool:
    """Given parts fit in their canonical forms or as written."""
    return any(same(x, y) for x in ((given_a, own_a) if own_a != given_a else (given_a,)) for y in ((given_b, own_b) if own_b != given_b else (given_b,)))


def _arrow(df: DataFrame, f, schema: pa.Schema, ddl: str) -> DataFrame:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [r for args in zip(*(c.to_pylist() for c in b.columns)) for r in f(*args)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, x.type) for c, x in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema
            )

    return df.transform(in_arrow, batches, ddl)


_PARSED = pa.schema(
    [("name", pa.string()), ("grp", pa.bool_()), ("full", pa.list_(pa.string())), ("ini", pa.list_(pa.string())),
     ("family", pa.string()), ("given", pa.list_(pa.string()))]
)


def parsed(strings: DataFrame) -> DataFrame:
    """Each different string of column ``name`` with its parts."""
    usable = strings.where(F.col("name").rlike(r"\p{L}") & ~F.lower("name").rlike(r"^\W*et\.? al\.?\W*$"))
    return _arrow(
        usable.select("name").distinct(),
        lambda name: [(name, *parse(name))],
        _PARSED,
        "name string, grp boolean, full array<string>, ini array<string>, family string, given array<string>",
    )


def token_counts(names: DataFrame) -> DataFrame:
    """(token, df, g, s): strings that hold it, and as what in forms that tell."""
    one = F.lit(1).cast("bigint")
    t = names.select(F.explode(F.array_distinct("full")).alias("token"), "family", "given")
    return t.groupBy("token").agg(
        F.sum(one).alias("df"),
        F.sum(F.array_contains("given", F.col("token")).cast("bigint")).alias("g"),
        F.sum(F.coalesce((F.col("family") == F.col("token")).cast("bigint"), F.lit(0))).alias("s"),
    )


def deletions(token: Column) -> Column:
    """The token, its single deletions and those of its form with plain umlauts."""

    def gaps(t: Column) -> Column:
        cut = lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))
        return F.concat(F.array(t), F.transform(F.sequence(F.lit(1), F.length(t)), cut))

    plain = F.regexp_replace(token, "(?<=[aou])e", "")
    return F.array_distinct(F.when(plain == token, gaps(token)).otherwise(F.concat(gaps(token), gaps(plain))))


def canonical_tokens(counts: DataFrame) -> DataFrame:
    """(token, canon): a rare token's better attested neighbour within one edit, else itself.

    Better attested: in at least RARE_RATIO times as many strings; for tokens of FEW strings
    simply in more, then with more neighbours, then the smaller token. So names that are
    both frequent stay apart.
    """
    index = counts.where(F.length("token") >= 3).select("token", F.explode(deletions(F.col("token"))).alias("gap"))
    close = (
        index.join(index.select(F.col("token").alias("near"), "gap"), "gap")
        .where(F.col("token") < F.col("near"))
        .select("token", "near")
        .distinct()
    )
    ab = _arrow(
        close,
        lambda t, n: [(t, n), (n, t)] if near(t, n) else [],
        pa.schema([("token", pa.string()), ("near", pa.string())]),
        "token string, near string",
    )
    ab = cut_lineage(ab)
    standing = counts.join(ab.groupBy("token").agg(F.count("*").alias("deg")), "token").select("token", "df", "deg")
    rank = F.struct((-F.col("df")).alias("df"), (-F.col("deg")).alias("deg"), F.col("token").alias("t"))
    ranked = standing.select("token", "df", rank.alias("rank"))
    best = (
        ab.join(ranked, "token")
        .join(ranked.select(F.col("token").alias("near"), F.col("df").alias("ndf"), F.col("rank").alias("nrank")), "near")
        .where((F.col("nrank") < F.col("rank")) & ((F.col("ndf") >= RARE_RATIO * F.col("df")) | (F.col("df") <= FEW)))
        .groupBy("token")
        .agg(F.min("nrank").alias("b"))
    )
    return counts.join(best, "token", "left").select("token", F.coalesce("b.t", "token").alias("canon"), "df", "g", "s")


_BLOCK = pa.schema([("name", pa.string()), ("block", pa.string()), ("given", pa.list_(pa.string())), ("own", pa.list_(pa.string()))])


def _block(name: str, grp: bool, full: list, ini: list, family: str | None, tokens: list) -> list[tuple]:
    """Block of one string with its given tokens, canonical and as written."""
    info = {t["token"]: t for t in tokens or []}
    canon = lambda t: info[t]["canon"] if t in info else t
    full = list(dict.fromkeys(full or []))
    if grp:
        return [(name, "#" + " ".join(sorted(canon(t) for t in full)), [], [])] if full else []
    if not full:
        return [(name, "." + "".join(ini or []), [], [])]
    if family is None:

        def score(k: int) -> tuple:
            rest = [t for i, t in enumerate(full) if i != k]
            mine = info.get(full[k], {})
            as_family = mine.get("cs", 0) - mine.get("cg", 0) + sum(info.get(t, {}).get("cg", 0) - info.get(t, {}).get("cs", 0) for t in rest)
            return as_family, -mine.get("cdf", 0), k

        family = full[max(range(len(full)), key=score)]
    given = [NICKNAMES.get(t) or NICKNAMES.get(canon(t), canon(t)) for t in full if t != family] + list(ini or [])
    own = [NICKNAMES.get(t, t) for t in full if t != family] + list(ini or [])
    return [(name, canon(family), given, own)]


def blocks(strings: DataFrame) -> DataFrame:
    """(name, block, given, own, cls) of every different string; ``cls`` numbers the given parts of a block."""
    names = cut_lineage(parsed(strings))
    canon = canonical_tokens(cut_lineage(token_counts(names)))
    # a mistyped token counts with the standing of its canonical form
    standing = canon.select(F.col("token").alias("canon"), F.col("df").alias("cdf"), F.col("g").alias("cg"), F.col("s").alias("cs"))
    full = canon.join(standing, "canon").select("token", F.struct("token", "canon", "cdf", "cg", "cs").alias("t"))
    held = (
        names.select("name", F.explode(F.array_distinct("full")).alias("token"))
        .join(full, "token")
        .groupBy("name")
        .agg(F.collect_list("t").alias("tokens"))
    )
    found = _arrow(
        names.join(held, "name", "left").select("name", "grp", "full", "ini", "family", "tokens"),
        _block,
        _BLOCK,
        "name string, block string, given array<string>, own array<string>",
    )
    return found.withColumn("cls", F.xxhash64("block", "given", "own"))


def class_links(members: DataFrame) -> DataFrame:
    """(block, cls_a, cls_b, rank_a, rank_b): linked classes, both ways; rank 0 has a full given name, 1 initials, 2 none."""
    one = members.groupBy("block", "cls").agg(F.first("given").alias("given"), F.first("own").alias("own"))
    other = one.select("block", *[F.col(c).alias(f"{c}_b") for c in ("cls", "given", "own")])
    facing = one.join(other, "block").where(F.col("cls") < F.col("cls_b"))

    def align(block: str, a: int, ga: list, oa: list, b: int, gb: list, ob: list) -> list[tuple]:
        if not fits(ga or [], oa or [], gb or [], ob or []):
            return []
        rank = lambda g: 2 if not g else int(len(g[0]) == 1)
        return [(block, a, b, rank(ga), rank(gb)), (block, b, a, rank(gb), rank(ga))]

    return _arrow(
        facing.select("block", "cls", "given", "own", "cls_b", "given_b", "own_b"),
        align,
        pa.schema([("block", pa.string()), ("cls_a", pa.int64()), ("cls_b", pa.int64()), ("rank_a", pa.int32()), ("rank_b", pa.int32())]),
        "block string, cls_a bigint, cls_b bigint, rank_a int, rank_b int",
    )


def linked(strings: DataFrame) -> DataFrame:
    """(name_a, name_b): strings that denote one entity."""
    members = cut_lineage(blocks(strings))
    own = members.select("block", F.col("cls").alias("cls_a"), F.col("name").alias("x"))
    other = members.select("block", F.col("cls").alias("cls_b"), F.col("name").alias("y"))
    links = class_links(members).where(F.col("cls_a") < F.col("cls_b"))
    across = links.join(own, ["block", "cls_a"]).join(other, ["block", "cls_b"])
    within = own.join(other.withColumnRenamed("cls_b", "cls_a"), ["block", "cls_a"]).where(F.col("x") < F.col("y"))
    both = across.select("x", "y").unionByName(within.select("x", "y"))
    return both.select(F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"))


def entities(strings: DataFrame) -> DataFrame:
    """(name, entity, links): each string with the smallest string of its entity and the number of strings linked to it.

    Entities are the connected classes of full given names; a class of initials, or without
    given name, belongs to the only entity that it is linked to, else to itself.
    """
    members = cut_lineage(blocks(strings))
    links = cut_lineage(class_links(members))
    sizes = members.groupBy("block", "cls").agg(F.count("*").alias("size"), F.min("name").alias("least"))
    label = sizes.select("block", "cls", F.col("least").alias("label"))
    for rank in (0, 1, 2):
        # links inside the rank connect; those to lower ranks only where they lead to one entity
        inner = links.where(f"rank_a = {rank} and rank_b = {rank}")
        up = links.where(f"rank_a = {rank} and rank_b < {rank}") if rank else None
        if up is not None:
            goal = up.join(label.withColumnRenamed("cls", "cls_b"), ["block", "cls_b"]).groupBy("block", "cls_a").agg(
                F.min("label").alias("one"), F.max("label").alias("last")
            )
            tied = goal.select("block", F.col("cls_a").alias("cls"), F.when(F.col("one") == F.col("last"), F.col("one")).alias("one"), F.lit(True).alias("led"))
            label = cut_lineage(label.join(tied, ["block", "cls"], "left").withColumn("label", F.coalesce("one", "label")).select("block", "cls", "label", F.coalesce("led", F.lit(False)).alias("led")))
            free = label.where("not led").select("block", F.col("cls").alias("cls_a"))
            inner = inner.join(free, ["block", "cls_a"], "left_semi").join(free.withColumnRenamed("cls_a", "cls_b"), ["block", "cls_b"], "left_semi")
            label = label.drop("led")
        while True:
            near = inner.join(label.withColumnRenamed("cls", "cls_b"), ["block", "cls_b"]).groupBy("block", F.col("cls_a").alias("cls")).agg(F.min("label").alias("near"))
            step = label.join(near, ["block", "cls"], "left").select("block", "cls", F.least("label", F.coalesce("near", "label")).alias("next"), "label")
            step = cut_lineage(step)
            label = step.select("block", "cls", F.col("next").alias("label"))
            if step.where("next <> label").isEmpty():
                break
    fellows = links.join(sizes.select("block", F.col("cls").alias("cls_b"), "size"), ["block", "cls_b"]).groupBy("block", F.col("cls_a").alias("cls")).agg(F.sum("size").alias("far"))
    n = sizes.join(fellows, ["block", "cls"], "left").select("block", "cls", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
    return members.join(label, ["block", "cls"]).join(n, ["block", "cls"]).select("name", F.col("label").alias("entity"), "links")


def author_strings(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """The name strings of the references and of the papers."""
    return refs.select(F.explode("authors").alias("name")).unionByName(
        papers.select(F.explode("author").alias("a")).select(F.col("a.name").alias("name"))
    )
