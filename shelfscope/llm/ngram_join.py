"""N-gram Jaccard join by token-combination prefixes.

Two sets of word shingles link if 100 times their intersection is at least 80 times
their union. The join never forms pairs it could do without:

1. Equal sets are one class. What follows sees each class once.
2. Extended prefixes. Similar sets share many of their first shingles in any fixed
   order; the longer the prefixes, the more of them. A class whose prefix shares
   fewer with all others than that is out.
3. The whole sets of the classes left are counted. A shingle that no other class has
   uses up one of the few differences a class may have.
4. Shingles that the same sets have, as those of one passage, become one token of so much
   weight. The tokens are ordered from rare to frequent, and the shortest prefix is taken
   whose tokens cannot all fail: rare ones and passages are indexed singly, frequent ones
   in combinations of two, very frequent ones of three. Hashed groups keep the number of
   combinations in proportion to the prefix.
5. Classes that share an index key are candidates, as far as what lies ahead of the key and
   behind it in both sets lets them share enough. Keys first compare all members with
   one hub; what that connects needs no further pairs.
6. Members of a key that are still apart, for example a thousand different changes of one
   text, are indexed once more, by what tells them from the hub: what both lack or both
   have besides counts, and such tokens are rare even where the members share most of
   their shingles. Every candidate is verified on its whole set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Workspace
from .components import connected_components
from .shingles import mix, shingle_sets

#: Least similarity in percent.
PERCENT = 80
#: A prefix is extended by a twentieth of the set, plus one.
EXTENSION = 20
#: Classes of shingles by the number of sets that have them, and how many are combined.
FREQUENT, VERY_FREQUENT = 16, 256
#: Sizes of the smaller set of a pair fall into buckets by powers of this.
STEP = 1.12
#: Shingles per group that are combined.
GROUP = 6
#: Sets smaller than this are indexed by single shingles only.
SMALL = 16
#: Up to so many ids are broadcast to pick rows of a large table; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def required_overlap(n: np.ndarray | int):
    """The least intersection of a set of n shingles with any set that it links with."""
    return (PERCENT * n + 99) // 100


def _extension(n):
    return -(-n // EXTENSION) + 1


def _prefix_length(n):
    return np.minimum(n, n - required_overlap(n) + 1 + _extension(n))


def _least_shared(n):
    """How many prefix shingles of a set any similar one has in its own prefix; the smallest partner decides."""
    smallest = required_overlap(n)
    return np.minimum(required_overlap(smallest), _extension(smallest) + 1)


def _sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    texts = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if offsets[-1] else np.empty(0, dtype=np.uint8)
    yield from shingle_sets(data, offsets)


def _class_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent sums over a set: equal sets, and for all purposes only those, agree in both."""
    first = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    second = mix(shingles ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return tuple(int(x) for x in mix(np.array([first, second]) + np.uint64(len(shingles))).view(np.int64))


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    values = np.concatenate([np.empty(0, dtype=np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(values))


def _digests(key: str, text: str, whole: bool):
    """Rows (id, n, class, check, shingles): the prefix in the order of the codes, or the whole set."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, first, second, kept = [], [], [], []
            for shingles in _sets_of(batch.column(text)):
                a, b = _class_key(shingles)
                n.append(len(shingles))
                first.append(a)
                second.append(b)
                kept.append(shingles if whole else shingles[: _prefix_length(len(shingles))])
            columns = [batch.column(key), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, _list_array(kept)], ["id", "n", "class", "check", "shingles"])

    return digest


def _keep_ids(df: DataFrame, column: Column, ids: DataFrame, rows: int, how: str) -> DataFrame:
    """A semi or anti join with ids; they are broadcast if they are few enough."""
    small = F.broadcast(ids) if rows <= BROADCAST_IDS else ids
    return df.join(small, column == ids[ids.columns[0]], how)


def _level(frequency: np.ndarray) -> np.ndarray:
    return 1 + (frequency > FREQUENT) + (frequency > VERY_FREQUENT)


def _bucket(n: int) -> int:
    """The sizes from ``STEP`` to this power on to the next one's."""
    return int(np.floor(np.log(n) / np.log(STEP) + 1e-9))


def index_keys(tokens: np.ndarray, weights: np.ndarray, frequency: np.ndarray, n: int, bucket: int) -> tuple[np.ndarray, ...]:
    """The keys of a set for pairs whose smaller size lies in ``bucket``, and what each says of the overlap.

    ``tokens`` stand for the shingles shared with other sets, ``weights`` of them each, rare
    ones first. In a similar set, tokens of no more weight can be missing than this one's
    shared shingles exceed the overlap. The prefix ends where so much could be missing and
    still one single, or one whole combination of a group, would be left: to break all
    combinations of k, all but the k - 1 heaviest tokens of the group would have to go. A set
    whose tokens are too few for that is indexed by all of them: of two similar sets either
    one's prefix ends, and the other has the same combinations, or both have all tokens.

    With each key go the weights ``ahead`` and ``rest``. If a single is the first one that two
    sets share, then of what comes before it only combined tokens can be common: the overlap
    is at most the lesser ``ahead`` plus the lesser ``rest``. Similar sets pass that test at
    their first common single, so a pair that fails it at a key need not be met there. For
    other keys ``rest`` is all.
    """
    size = STEP**bucket
    # Both sets of such a pair have at least the bucket's least size.
    least = math.ceil(size * (1 - 1e-9))
    overlap = max(int(required_overlap(n)), -(-PERCENT * (n + least) // (100 + PERCENT)))
    shared = int(weights.sum())
    missing = shared - overlap
    nothing = np.empty(0, dtype=np.int64)
    if missing < 0:
        return nothing.view(np.uint64), nothing, nothing, nothing.astype(bool)
    # A token of several shingles is a passage: what it is combined with would be no rarer.
    levels = np.where(weights > 1, 1, _level(frequency)) if size >= SMALL else np.ones(len(tokens), dtype=np.int64)
    groups = max(1, round(size * (100 - PERCENT) / 100 / (GROUP - 1)))
    group = (mix(tokens) % np.uint64(groups)).astype(np.int64)
    members: dict[tuple[int, int], list[int]] = {}
    heavy: dict[tuple[int, int], list[int]] = {}
    sure, ahead, rest, salt = 0, 0, shared, np.uint64(bucket + 1)
    singles: list[tuple[int, int, int]] = []
    for value, weight, level, number in zip(tokens.tolist(), weights.tolist(), levels.tolist(), group.tolist(), strict=True):
        if sure > missing:
            break
        if level == 1:
            singles.append((value, ahead, rest))
            sure += weight
        else:
            members.setdefault((level, number), []).append(value)
            most = heavy.setdefault((level, number), [])
            most.append(weight)
            if len(most) == level:
                sure += most.pop(most.index(min(most)))
            ahead += weight
        rest -= weight
    own_salt = mix(np.array([salt]))[0]
    parts = [mix(np.array([t for t, _, _ in singles], dtype=np.uint64) + own_salt)]
    for (level, _), own in members.items():
        chosen = np.array(list(combinations(sorted(own), level)), dtype=np.uint64).reshape(-1, level)
        code = mix(np.array([salt + np.uint64(level << 32)]))[0]
        total = np.full(len(chosen), code)
        for k in range(level):
            total = mix(total + chosen[:, k])
        parts.append(total)
    if sure <= missing:
        parts.append(mix(np.array([t for own in members.values() for t in own], dtype=np.uint64) + own_salt))
    keys = np.concatenate(parts)
    before, after = np.zeros(len(keys), dtype=np.int64), np.full(len(keys), shared, dtype=np.int64)
    before[: len(singles)], after[: len(singles)] = [a for _, a, _ in singles], [r for _, _, r in singles]
    return keys, before, after, np.arange(len(keys)) < len(singles)


_KEYS = "key long, class long, n long, shared long, ahead long, rest long, single boolean"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_KEYS`` from rows (class, n, entries of frequency, shingle and token)."""
    for batch in batches:
        entries = batch.column("entries")
        offsets = np.asarray(entries.offsets)
        values = entries.values
        frequency = np.asarray(values.field("frequency"))
        every = np.asarray(values.field("token")).view(np.uint64)
        classes, sizes = np.asarray(batch.column("class")), np.asarray(batch.column("n"))
        for i in range(batch.num_rows):
            at, n = slice(offsets[i], offsets[i + 1]), int(sizes[i])
            # The smaller set of a pair may have as few as the overlap that this one requires.
            buckets = range(_bucket(int(required_overlap(n))), _bucket(n) + 1)
            tokens, first, weights = np.unique(every[at], return_index=True, return_counts=True)
            often = frequency[at][first]
            order = np.lexsort((tokens, often))
            of_set = tokens[order], weights[order], often[order]
            keys, ahead, rest, single = map(np.concatenate, zip(*(index_keys(*of_set, n, b) for b in buckets), strict=True))
            if len(keys):
                count = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.full(count, classes[i])),
                        pa.array(np.full(count, n)),
                        pa.array(np.full(count, offsets[i + 1] - offsets[i], dtype=np.int64)),
                        pa.array(ahead),
                        pa.array(rest),
                        pa.array(single),
                    ],
                    [field.split()[0] for field in _KEYS.split(", ")],
                )


#: What is known of a key's member.
_MEMBER = ("class", "n", "shared", "ahead", "rest")
#: Two lists of distinct classes that agree in these, and in length, are the same for all purposes.
_SAME_MEMBERS = ("low", "high", "mark", "check")


def _members() -> list[Column]:
    """A list of classes as its ends and two independent exclusive-ors, added up inside map tasks."""
    marks = F.bit_xor(F.xxhash64("class")).alias("mark"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("check")
    return [F.min("class").alias("low"), F.max("class").alias("high"), *marks]


def _can_link() -> Column:
    """Whether a set and a hub that meet at a key can share enough."""
    most = F.least("shared", "l_shared", F.least("ahead", "l_ahead") + F.least("rest", "l_rest"))
    return 100 * most >= PERCENT * (F.col("n") + F.col("l_n") - most)


@dataclass(frozen=True)
class _Sets:
    """Classes that may link: their sizes and shared shingles, and the keys that index them."""

    sets: DataFrame
    keys: DataFrame


def _surviving(digests: DataFrame, space: Workspace) -> tuple[DataFrame, int]:
    """Classes whose prefix shares enough shingles with other classes' prefixes."""
    rows = digests.filter("n > 0").select("class", "n", F.explode("shingles").alias("shingle")).repartition("shingle")
    found = rows.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    shared = found.filter("low != high").select("shingle")
    counts = rows.join(shared, "shingle", "left_semi").groupBy("class").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("hits"))
    overlap = F.floor((PERCENT * F.col("n") + 99) / 100)
    least = F.least(F.floor((PERCENT * overlap + 99) / 100), F.ceil(overlap / EXTENSION) + 2)
    alive = space.stage(counts.filter(F.col("hits") >= least).select("class"), "alive")
    return alive.frame, alive.rows


def _indexed(whole: DataFrame, space: Workspace) -> _Sets:
    """Count all shingles of the surviving classes, drop those that cannot link, index the rest."""
    rows = whole.select("class", "n", F.explode("shingles").alias("shingle")).repartition("shingle")
    # Shingles that the same sets have, as those of one passage, are one token of so much weight.
    token = F.xxhash64("frequency", *_SAME_MEMBERS).alias("token")
    frequency = rows.groupBy("shingle").agg(*_members(), F.count(F.lit(1)).alias("frequency"))
    shared = rows.join(frequency.filter("low != high").select("shingle", "frequency", token), "shingle")
    entry = F.struct("frequency", "shingle", "token")
    grouped = shared.groupBy("class").agg(F.max("n").alias("n"), F.sort_array(F.collect_set(entry)).alias("entries"))
    fits = grouped.filter(F.size("entries") >= F.floor((PERCENT * F.col("n") + 99) / 100))
    sets = space.stage(fits, "sets").frame
    keys = sets.mapInArrow(_index, _KEYS)
    listed = space.stage(keys, "keys").frame
    # Combinations with the same members say the same, so one of them is kept; each single says its own.
    several = listed.groupBy("key").agg(
        *_members(), F.count(F.lit(1)).alias("n_sets"), F.max(F.when(F.col("single"), F.col("key"))).alias("of_its_own")
    )
    different = several.filter("low != high").groupBy("n_sets", "of_its_own", *_SAME_MEMBERS).agg(F.min("key").alias("key"))
    # The members of a hot key come from a staged table, so the join can be split.
    keyed = space.stage(different.select("key"), "several").frame
    return _Sets(sets, space.stage(listed.join(keyed, "key", "left_semi"), "candidates").frame)


def _verified(pairs: DataFrame, lists: DataFrame, space: Workspace) -> tuple[DataFrame, int]:
    """Those of the pairs (a, b) whose whole sets are similar, and their number."""
    wanted = space.stage(pairs, "pairs")
    one = lists.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = lists.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = wanted.frame.join(two, "b").join(one, "a")
    common = F.size(F.array_intersect("s_a", "s_b"))
    found = both.filter(100 * common >= PERCENT * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")
    found = space.stage(found, "links")
    return found.frame, found.rows


def _ordered(one: str, two: str) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _differences(visits: DataFrame, lists: DataFrame) -> DataFrame:
    """What tells each visitor of a hub from it: ``tokens``, and the ``need`` that they have to meet.

    Of the hub's shared shingles two visitors have in common all that neither misses. So
    their overlap is the hub's count, less what either misses, plus the differences from the
    hub that they have in common. They are similar if twice (100 + PERCENT) times those
    common differences is at least the sum of both needs.
    """
    own = lists.select("class", F.col("shingles").alias("own"))
    hubs = lists.select(F.col("class").alias("hub"), F.col("shingles").alias("of_hub"))
    missing = F.array_except("of_hub", "own")
    need = 2 * PERCENT * F.col("n") + (100 + PERCENT) * (2 * F.size(missing) - F.size("of_hub"))
    tokens = F.concat(F.array_except("own", "of_hub"), F.transform(missing, lambda t: F.bitwise_not(t)))
    told = visits.join(own, "class").join(hubs, "hub")
    return told.select("hub", "class", "group", "inside", need.cast("long").alias("need"), tokens.alias("tokens"))


def _difference_pairs(open_: DataFrame, hubs: DataFrame, lists: DataFrame, space: Workspace) -> DataFrame:
    """Pairs (a, b) of different groups that may be similar, among those that share a key with a hub.

    Visitors of a hub are indexed by their differences from it, rare ones first: a pair whose
    needs add up to more than what is left behind either prefix shares a token of both. Those
    in the hub's group and those outside have prefixes of their own for each side, as the
    least need on the other side decides the length. Where needs add up to no more
    than zero the pair is similar, and then so is either with the one of least need.
    """
    home = hubs.select("key", F.col("l_class").alias("hub"))
    groups = open_.select(F.col("class").alias("hub"), F.col("group").alias("home")).distinct()
    met = open_.join(home, "key").filter("class != hub").select("hub", "class", "n", "group").distinct()
    visits = met.join(groups, "hub").withColumn("inside", F.col("group") == F.col("home"))
    told = space.stage(_differences(visits, lists), "differences").frame
    least = F.struct("need", "class")
    mins = told.groupBy("hub").agg(
        F.min(F.when(F.col("inside"), least)).alias("least_inside"),
        F.min(F.when(~F.col("inside"), least)).alias("least_outside"),
    )
    mins = space.stage(mins.filter("least_outside is not null"), "least").frame
    # Inside is compared with outside (side 1), outside also with itself (side 0).
    facing = F.when(F.col("inside"), F.col("least_outside")).otherwise(F.col("least_inside"))
    outside = F.struct(F.lit(0).alias("side"), F.col("least_outside").alias("least"))
    across = F.struct(F.lit(1).alias("side"), facing.alias("least"))
    sides = F.when(F.col("inside"), F.array(across)).otherwise(F.array(outside, across))
    visitor = ("hub", "class", "group", "inside", "need")

    needed = told.join(mins.select("hub"), "hub", "left_semi")
    rows = needed.select(*visitor, F.explode("tokens").alias("shingle"))
    frequency = rows.groupBy("hub", "shingle").agg(*_members(), F.count(F.lit(1)).alias("frequency")).filter("low != high")
    token = F.xxhash64("frequency", *_SAME_MEMBERS).alias("token")
    shared = rows.join(frequency.select("hub", "shingle", "frequency", token), ["hub", "shingle"])
    grouped = shared.groupBy(*visitor).agg(F.sort_array(F.collect_list(F.struct("frequency", "token"))).alias("entries"))
    sided = grouped.join(mins, "hub").withColumn("of", F.explode(sides)).filter("of.least is not null")
    spare = F.greatest(F.lit(0), F.floor((F.col("need") + F.col("of.least.need") - 1) / (2 * (100 + PERCENT))))
    places = F.transform("entries", lambda e, i: F.struct(e["token"].alias("token"), i.alias("place")))
    # Tokens that the same visitors have stand together; the first of them is the key.
    first = F.filter(
        places,
        lambda e: (e["place"] < F.size("entries") - spare)
        & ((e["place"] == 0) | (F.get("entries", e["place"] - 1)["token"] != e["token"])),
    )
    at = sided.select(*visitor, "of.side", F.size("entries").alias("size"), F.explode(first).alias("at"))
    key, rest = F.xxhash64("hub", "side", "at.token").alias("key"), (F.col("size") - F.col("at.place")).alias("rest")
    keyed = space.stage(at.select(key, "class", "group", "inside", "need", "side", rest), "told").frame
    apart = keyed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low != high")
    keyed = space.stage(keyed.join(apart.select("key"), "key", "left_semi"), "told-apart").frame
    other = keyed.select("key", *(F.col(c).alias(f"l_{c}") for c in ("class", "group", "inside", "need", "rest")))
    fits = 2 * (100 + PERCENT) * F.least("rest", "l_rest") >= F.col("need") + F.col("l_need")
    across_sides = (F.col("side") == 0) | (F.col("inside") != F.col("l_inside"))
    differ = (F.col("class") < F.col("l_class")) & (F.col("group") != F.col("l_group"))
    close = keyed.join(other, "key").filter(differ & fits & across_sides).select(*_ordered("class", "l_class"))
    certain = needed.join(mins, "hub").withColumn("of", F.explode(sides))
    certain = certain.filter((F.col("need") + F.col("of.least.need") <= 0) & (F.col("class") != F.col("of.least.class")))
    return close.unionByName(certain.select(*_ordered("class", "of.least.class"))).distinct()


def _links(indexed: _Sets, space: Workspace) -> DataFrame | None:
    """Verified links (a, b) between classes, enough to connect all that are similar."""
    lists = indexed.sets.select("class", "n", F.transform("entries", lambda e: e["shingle"]).alias("shingles"))
    lists = space.stage(lists, "lists").frame
    # The hub of a key is the set with the fewest shingles of its own: a text that many
    # others were copied from has none.
    central = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("own"), *_MEMBER)
    best = indexed.keys.groupBy("key").agg(F.min(central).alias("best"))
    hubs = space.stage(best.select("key", *(F.col(f"best.{c}").alias(f"l_{c}") for c in _MEMBER)), "hubs").frame
    met = indexed.keys.join(hubs, "key").filter((F.col("class") != F.col("l_class")) & _can_link())
    links, found = _verified(met.select(*_ordered("class", "l_class")).distinct(), lists, space)
    members = indexed.keys.select("key", "class", "n", F.col("class").alias("group"))
    if found:
        groups = connected_components(links, space)
        named = members.drop("group").join(groups, members["class"] == groups["node"], "left")
        members = space.stage(named.select("key", "class", "n", F.coalesce("component", "class").alias("group")), "members").frame
    apart = members.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low != high")
    apart = space.stage(apart.select("key"), "apart")
    if apart.rows:
        open_ = space.stage(members.join(apart.frame, "key", "left_semi"), "open").frame
        more, rows = _verified(_difference_pairs(open_, hubs, lists, space), lists, space)
        if rows:
            links, found = links.unionByName(more), found + rows
    return links if found else None


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``n_shingles``, ``component_id``) for every row.

    ``n_shingles`` is the size of the row's set of distinct 5-word shingles; a text with
    fewer words is one shingle, an empty or null one none, and it links with nothing.
    ``component_id`` is the smallest key reachable by links, its own included. Rows of
    equal sets link. A null key names no component but that of a row that links with
    nothing, or only with null keys. Other columns don't matter.

    The work is done when the function returns; the result reads staged tables.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    layout = f"id {kind}, n long, class long, check long, shingles array<bigint>"
    out = Workspace(spark, "jaccard")
    with Workspace(spark, "jaccard-join") as space:
        digests = space.stage(plain.mapInArrow(_digests("id", "text", False), layout), "digests")
        rows = out.stage(digests.frame.select("id", "n", "class", "check"), "rows").frame
        classes = rows.filter("n > 0").groupBy("class", "check").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        classes = space.stage(classes, "classes", copies=F.sum("copies"))
        first = classes.frame.select("first")
        copies = (classes.figures["copies"] or 0) - classes.rows
        one_each = digests.frame
        if copies:
            # All rows but the first of a class are left out; null keys are too few to name, so they stay.
            later = rows.filter("n > 0").select(F.col("id").alias("later")).join(first, F.col("later") == F.col("first"), "left_anti")
            one_each = _keep_ids(digests.frame, digests.frame["id"], later.filter("later is not null"), copies, "left_anti")
        alive, count = _surviving(one_each, space)
        digests.drop()
        links = None
        if count:
            picked = space.stage(
                classes.frame.join(alive, "class", "left_semi").select("first"), "picked", unnamed=F.count_if(F.col("first").isNull())
            )
            texts = _keep_ids(plain, plain["id"], picked.frame, picked.rows, "left_semi")
            if picked.figures["unnamed"]:
                texts = texts.unionByName(plain.filter("id is null"))
            whole = space.stage(texts.mapInArrow(_digests("id", "text", True), layout).select("class", "n", "shingles"), "whole")
            links = _links(_indexed(whole.frame, space), space)
        named = classes.frame.select("class", "check", "first")
        if links is not None:
            groups = connected_components(links, space)
            named = named.join(groups, named["class"] == groups["node"], "left").drop("node")
            named = space.stage(named.withColumn("group", F.coalesce("component", "class")), "named").frame
            least = named.groupBy("group").agg(F.min("first").alias("name"))
            named = named.join(least, "group").select("class", "check", "name")
        else:
            named = named.withColumnRenamed("first", "name")
        result = out.stage(named, "names").frame
    joined = rows.join(result, ["class", "check"], "left")
    return joined.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("name", "id").alias("component_id")
    )
