"""Joins of near-equal documents by the Jaccard similarity of word shingles, with a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, components, drop_caches, durable, forget, shuffle_width, written

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BATCH = 1000  # rows that hold texts or token sets, at once
STEP = np.random.default_rng(5).integers(1, 2**63, 64, np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Plan:
    """words of a shingle; similarity in hundredths; one document in so many is counted to order shingles; slots of the
    table of that order, a byte each, and bits of the tables of wanted numbers, which tasks get whole; tokens of a matrix
    and of the queries that it meets."""

    words: int = 5
    percent: int = 75
    counted: int = 16
    slots: int = 1 << 20
    bits: int = 1 << 24
    members: int = 1 << 20
    queries: int = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * M1
    x = (x ^ x >> np.uint64(27)) * M2
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit numbers. Letters A-Z are lower-cased, words stand between ASCII
    white space; fewer words than a shingle's give one number for the whole sequence, none give an empty set."""
    cut = pc.split_pattern_regex(pc.ascii_lower(texts), r"[ \t\n\v\f\r]+")
    coded = cut.flatten().dictionary_encode()
    names = coded.dictionary.to_pandas().to_numpy(object)
    numbers = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    real = np.array([w != "" for w in names], bool)
    index = coded.indices.to_numpy(zero_copy_only=False)
    kept = real[index] if len(index) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(kept)])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
    flat = mix(numbers)[index[kept]] if len(index) else np.zeros(0, np.uint64)
    last = max(len(flat) - words + 1, 0)
    rolled = np.zeros(last, np.uint64)
    for k in range(words):
        rolled += flat[k : k + last] * STEP[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            out.append(mix(np.array([(flat[a:b] * STEP[words + 1 : words + 1 + b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_of(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set in the order of (level, token): so many that two sets which reach the similarity share
    one of them. The order is the same for all sets, so any table of levels will do; rare tokens in front save work."""
    n = len(tokens)
    keep = n - -(-percent * n // 100) + 1 if n else 0
    level = levels[(tokens % np.uint64(len(levels))).astype(np.int64)]
    return tokens[:keep] if not level.any() else tokens[np.argsort(level, kind="stable")[:keep]]


def alike(n: int, m: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def may_link(percent: int) -> str:
    """SQL: whether a query of n tokens may link with a member of low to high tokens, when the union of the group's
    prefixes holds common of the query's prefix tokens.

    Of two sets take the one whose prefix ends first: what they share lies in both prefixes or beyond that one, where it
    has under t * size tokens, t being the similarity. And they must share t / (1 + t) of their sizes' sum. So they need
    t / (1 + t) * (n + m) - t * max(n, m) in common, which is least for the shortest or the longest member that fits.
    """
    short, long = f"greatest(low, cast(ceil({percent} * n / 100) as bigint))", f"least(high, cast(floor(100 * n / {percent}) as bigint))"
    need = lambda m: f"{100 * percent} * (n + {m}) - {percent * (100 + percent)} * greatest(n, {m})"
    return f"{short} <= {long} and {100 * (100 + percent)} * common >= least({need(short)}, {need(long)})"


class Matrix:
    """A group's tokens with the member that holds each, sorted; their union bounds what a query can share."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.holder = tokens[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members that the query links with. The group is opened only if its union holds enough of the query."""
        low, high = np.searchsorted(self.tokens, query), np.searchsorted(self.tokens, query, side="right")
        if 100 * int((high > low).sum()) < percent * len(query):
            return np.zeros(0, np.int64)
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(self.holder[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (len(query) + self.sizes - common))


class Joined:
    """Which components of a matrix's members and queries are joined by the links found so far."""

    def __init__(self, members: np.ndarray):
        self.up: dict[int, int] = {}
        self.held = set(np.unique(members).tolist())  # roots of members

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def done(self, x: int) -> bool:
        """Whether all members are in x's set, so that no link can join more."""
        return len(self.held) == 1 and self.root(x) in self.held

    def join(self, x: int, y: int) -> bool:
        """Joins the sets of a query and a member; False where they are one."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[x] = y
        self.held.discard(x)
        return True


def texts_in(batches: Iterator[pa.RecordBatch], plan: Plan, chars: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with the shingle sets of their text, so many at a time as have about chars bytes of text, one at least."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + chars, side="right")))
            some = batch.slice(at, end - at)
            yield some, shingle_sets(pc.coalesce(some["text"], pa.scalar("", some["text"].type)), plan.words)
            at = end


def token_levels(docs: DataFrame, plan: Plan) -> np.ndarray:
    """A table of plan.slots levels: the logarithm of how often the most frequent shingle of a slot was counted, 0 under
    three. It only orders shingles, so what the count leaves out costs time and no link."""

    def count(batches):
        drop_caches()
        for _, found in texts_in(batches, plan):
            tokens, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(plan.counted)) == 0)
    often = some.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 3")
    slot = F.pmod("token", F.lit(plan.slots)).cast("int")  # slots are a power of two, so signs do not matter
    table = often.groupBy(slot.alias("slot")).agg(F.floor(F.log2(F.max("n"))).cast("int").alias("level")).toArrow()  # plan.slots rows at most
    levels = np.zeros(plan.slots, np.uint8)
    levels[table["slot"].to_numpy()] = table["level"].to_numpy()
    return levels


def word_and_bit(number: Column, bits: int) -> tuple[Column, Column]:
    """The word of a table of bits, a power of two of them, and the bit in it that stand for a number."""
    return F.shiftright(number.bitwiseAND(F.lit(bits - 1)), 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))


def bits_of(df: DataFrame, number: Column, bits: int) -> DataFrame:
    """(word, bits): a table of bits in words of 64, bits / 64 rows at most: those of the numbers are set."""
    word, bit = word_and_bit(number, bits)
    return df.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def wanted_bits(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """The words of the table of bits of the column's numbers. Where it is full it sorts nothing out, and only saves no
    work."""
    table = bits_of(df, F.col(column), bits).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return words


def wanted(numbers: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = numbers.view(np.uint64) & np.uint64(64 * len(words) - 1)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1


class Cuts:
    """What has been written to the shared folder under a name, until nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        found, self.paths[name] = written(df)
        return found

    def drop(self, *names: str) -> None:
        for name in names:
            forget(self.spark, self.paths.pop(name))


def link_classes(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links of at least the similarity reach.

    1. One pass over the texts gives each row its set's size, a 128-bit signature and a prefix of its tokens: two sets
       that reach the similarity have a prefix token in common. Rows with equal sets form a class, one node.
    2. Partition: a node whose prefix shares enough with the smallest node of its tokens, its leader, is of that leader's
       group; others are groups of their own.
    3. The matrix of prefix tokens and groups: where a token stands in several groups, the nodes of one may query the
       other. How many prefix tokens the group's union holds of the query's bounds their similarity; only groups that may
       reach it are queried, and all nodes query their own group.
    4. Each node is compared with its leader; verified links make components. So a large group of alike texts costs one
       comparison a text. Queries of groups that lie wholly in the query's component are done with.
    5. For the rest, a group's tokens are stored in matrices of bounded size. One whose token union holds too little of
       the query is not opened; in others the query meets all members. Links that join no more are left out, and queries whose
       matrix is joined in whole are done with.

    No linked pair is missed: its nodes are in one group, or a common prefix token makes one query the other's group.
    Texts without words (null too) link with nothing. Repeated ids and rows are rows of their own: two texts under one id
    are two nodes, which have the smallest id of each one's component; a null id has a null component, and its text takes
    no part; other columns are left out; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    levels = token_levels(docs, plan)

    def sets(batches):
        drop_caches()
        for some, found in texts_in(batches, plan):
            mixed = [mix(s) for s in found]
            firsts = [prefix_of(s, levels, plan.percent) for s in found]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                some["doc_id"], pa.array([len(s) for s in found], pa.int64()),
                pa.array([int(s.sum().view(np.int64)) for s in mixed], pa.int64()),
                pa.array([int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0 for s in mixed], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(firsts).view(np.int64))),
            ], ["doc_id", "n", "s1", "s2", "prefix"])

    spark = df.sparkSession
    cuts = Cuts(spark)
    with batch_rows(spark, BATCH):
        wide = cuts.write("wide", docs.mapInArrow(sets, "doc_id long, n long, s1 long, s2 long, prefix array<long>"))
    rows = durable(wide.drop("prefix"))
    held = wide.where("n > 0 and doc_id is not null").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("holder"), F.any_value("prefix").alias("prefix"))
    fronts = cuts.write("fronts", held.withColumn("node", F.monotonically_increasing_id()))
    cuts.drop("wide")
    firsts = fronts.select("node", F.explode("prefix").alias("token"))
    ends = cuts.write("ends", firsts.groupBy("token").agg(F.min("node").alias("leader"), F.count("*").alias("nodes")).where("nodes > 1").drop("nodes"))
    often = wanted_bits(ends, "token", plan.bits)

    def not_alone(batches):
        for batch in batches:
            token = batch["prefix"].flatten().to_numpy()
            keep = wanted(token, often)
            owner = np.repeat(batch["node"].to_numpy(), pc.list_value_length(batch["prefix"]).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(owner[keep]), pa.array(token[keep])], ["node", "token"])

    several = fronts.select("node", "prefix").mapInArrow(not_alone, "node long, token long")
    shared = cuts.write("shared", several.join(ends, "token"))  # tokens in front of several nodes
    classes = cuts.write("classes", fronts.select("s1", "s2", "n", "holder", "node", F.size("prefix").alias("held")))
    cuts.drop("fronts", "ends")
    votes = shared.where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("votes"))
    led = votes.groupBy("node").agg(F.max(F.struct("votes", (-F.col("leader")).alias("leader"))).alias("x"))
    size = classes.select("node", "n", "held")
    enough = F.col("x.votes") * 5 >= F.col("held")
    seen = shared.select("node").distinct().join(size, "node").join(led, "node", "left")
    grouped = cuts.write("grouped", seen.select("node", "n", F.when(enough, -F.col("x.leader")).alias("leader")).withColumn("grp", F.coalesce("leader", "node")))
    placed = shared.select("token", "node").join(grouped.drop("leader"), "node").select("token", "node", "n", "grp")
    several = placed.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("token")
    mixed = cuts.write("mixed", placed.join(several, "token"))
    cuts.drop("shared")
    matrix = mixed.groupBy("token", "grp").agg(F.min("n").alias("low"), F.max("n").alias("high")).toDF("token", "grp_", "low", "high")
    met = mixed.join(matrix, "token").where("grp > grp_").groupBy("node", "n", F.col("grp_").alias("grp")).agg(F.count("*").alias("common"), F.min("low").alias("low"), F.max("high").alias("high"))
    asks = met.where(may_link(plan.percent)).select("node", "grp")
    own = grouped.where("leader is not null").select("node", "grp").unionByName(grouped.join(grouped.select("leader").distinct().toDF("node"), "node", "left_semi").select("node", F.col("node").alias("grp")))
    asks = cuts.write("asks", asks.unionByName(own).distinct())
    cuts.drop("mixed")
    used = asks.select("node").unionByName(grouped.join(asks.select("grp").distinct(), "grp", "left_semi").select("node")).distinct()
    nodes = cuts.write("nodes", used.join(grouped, "node").join(classes.select("node", "holder", "s1"), "node").select("node", "leader", "grp", "holder", "s1"))

    def tokens(batches):
        drop_caches()
        for some, found in texts_in(batches, plan):
            good = [j for j, (s, x) in enumerate(zip(found, some["s1"].to_pylist(), strict=True)) if int(mix(s).sum().view(np.int64)) == x]
            part = some.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                part["node"], part["leader"], part["grp"], pa.array([len(found[j]) for j in good], pa.int64()), pa.array([found[j].tobytes() for j in good], pa.binary()),
            ], ["node", "leader", "grp", "n", "tokens"])

    holders = wanted_bits(nodes, "holder", plan.bits)

    def of_holders(batches):
        for batch in batches:
            yield batch.filter(pa.array(wanted(batch["doc_id"].to_numpy(), holders)))

    some = docs.where("doc_id is not null and text is not null").mapInArrow(of_holders, docs.schema)
    # Of an id that repeats, all texts meet the node here; equal ones are dropped, those of another signature left out.
    texts = nodes.join(some, F.col("holder") == F.col("doc_id")).select("holder", "node", "leader", "grp", "s1", "text").distinct()
    with batch_rows(spark, BATCH):
        active = cuts.write("active", texts.mapInArrow(tokens, "node long, leader long, grp long, n long, tokens binary"))
    cuts.drop("nodes")

    def compare(batches):
        drop_caches()
        for batch in batches:
            good = []
            for k, (x, y) in enumerate(zip(batch["tokens"], batch["others"], strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if alike(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), plan.percent):
                    good.append(k)
            part = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([part["node"], part["leader"]], ["a", "b"])

    other = active.select("node", "n", "tokens").toDF("leader", "m", "others")
    near = active.where("leader is not null").join(other, "leader").where(f"100 * least(n, m) >= {plan.percent} * greatest(n, m)")
    with batch_rows(spark, BATCH):
        links = cuts.write("links", near.select("node", "leader", "tokens", "others").mapInArrow(compare, "a long, b long"))
    stars = cuts.write("stars", components(links))
    comp = cuts.write("comp", grouped.select("node", "n", "grp").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node")))
    groups = comp.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("held"))
    asks = cuts.write("open", asks.join(comp.drop("grp"), "node").join(groups, "grp").where("low <> component or high <> component"))
    cuts.drop("links", "asks", "grouped")
    found = stars
    if not asks.isEmpty():
        counts = asks.groupBy("grp", "held").agg(F.sum("n").alias("asked"))
        counts = cuts.write("counts", counts.select("grp", F.expr(f"cast(ceil(held / {plan.members}) as int)").alias("mc"), F.expr(f"cast(ceil(asked / {plan.queries}) as int)").alias("qc"), F.expr("held + asked").alias("load")))
        # Matrices are dealt to so many tasks that each has about one of full size, or to those that Spark has anyway.
        tasks = max(shuffle_width(spark), int(counts.agg(F.sum("load")).first()[0]) // plan.members)
        deal = F.expr(f"cast(pmod(xxhash64(grp, mp, qp), {tasks}) as int)").alias("task")
        known = active.select("node", "grp", "tokens").join(comp.select("node", "component"), "node")
        members = known.join(counts, "grp").select(
            "grp", F.expr("cast(pmod(xxhash64(node), mc) as int)").alias("mp"), F.explode(F.expr("sequence(0, qc - 1)")).alias("qp"), "node", "component", "tokens"
        )
        queries = asks.select("node", "grp", "component").join(counts, "grp").join(active.select("node", "tokens"), "node").select(
            "grp", F.explode(F.expr("sequence(0, mc - 1)")).alias("mp"), F.expr("cast(pmod(xxhash64(node, 3), qc) as int)").alias("qp"), "node", "component", "tokens"
        )

        def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            drop_caches()
            a, b = [], []
            held = left.groupby(["grp", "mp", "qp"]).indices
            for key, some in right.groupby(["grp", "mp", "qp"]).indices.items():
                if key in held:
                    at = held[key]
                    ids, comps = left["node"].to_numpy()[at], left["component"].to_numpy()[at]
                    matrix, sets = Matrix([np.frombuffer(x, np.uint64) for x in left["tokens"].to_numpy()[at]]), Joined(comps)
                    for q, c, x in zip(right["node"].to_numpy()[some], right["component"].to_numpy()[some].tolist(), right["tokens"].to_numpy()[some], strict=True):
                        if sets.done(c):
                            continue
                        hit = matrix.linked(np.frombuffer(x, np.uint64), plan.percent)
                        for k in hit[np.unique(comps[hit], return_index=True)[1]].tolist():
                            if sets.join(c, int(comps[k])):
                                a.append(q)
                                b.append(ids[k])
            return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

        queries = queries.select("*", deal).toDF(*queries.columns, "task")
        more = members.select("*", deal).groupBy("task").cogroup(queries.groupBy("task")).applyInPandas(ask, "a long, b long")
        more = cuts.write("more", more)
        cuts.drop("active", "counts")
        found = components(stars.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = classes.drop("held").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("holder").alias("component_id"))
    reach = durable(named.join(least, "component").select("s1", "s2", F.col("n").alias("n_"), "component_id"))
    cuts.drop(*cuts.paths)  # but for rows and reach, which the result reads
    some = rows.join(reach, (rows.s1 == reach.s1) & (rows.s2 == reach.s2) & (rows.n == reach.n_) & (rows.n > 0), "left")
    return some.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def free_name(stem: str, df: DataFrame, *others: str) -> str:
    """A name that no column of df has, nor others."""
    taken = {c.lower() for c in df.columns} | set(others)
    while stem.lower() in taken:
        stem += "_"
    return stem


def without(rows: DataFrame, key: str, gone: DataFrame, plan: Plan) -> DataFrame:
    """The rows whose key, a number and not null, is none of gone's only column. A table of bits of fixed size, which all
    tasks get, tells most rows that stay; only the others meet gone, so rows that hold much are not shuffled for it. Where
    that table is full all rows meet gone."""
    gone = durable(gone.toDF("gone").withColumn("gone", F.col("gone").cast("bigint")))
    place = lambda c: c.bitwiseXOR(F.shiftright(c, 33) * F.lit(1_000_003))  # noqa: E731 (numbers that Spark gives rows have the part above)
    word, bits = free_name("_word", rows), free_name("_bits", rows)
    table = bits_of(gone, place(F.col("gone")), plan.bits).toDF(word, bits)
    number = rows[key].cast("bigint")
    at, bit = word_and_bit(place(number), plan.bits)
    told = rows.join(F.broadcast(table), at == table[word], "left").withColumn(bits, F.coalesce(F.col(bits).bitwiseAND(bit), F.lit(0)) != 0).drop(word)
    doubted = told.where(F.col(bits))
    return told.where(~F.col(bits)).unionByName(doubted.join(gone, doubted[key].cast("bigint") == gone["gone"], "left_anti")).drop(bits)


def keep_first(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, with all its columns, of the smallest id of each component. Of rows that repeat id and text one
    stays; texts that share an id are linked and decided one by one. Rows with a null id link with nothing and stay. Other
    columns may have any names."""
    named, rest = df.where(F.col(id_col).isNotNull()), df.where(F.col(id_col).isNull())
    if named.groupBy(id_col).count().where("count > 1").isEmpty():
        later = link_classes(named, plan, id_col, text_col).where("doc_id <> component_id").select("doc_id")
        return without(named, id_col, later, plan).unionByName(rest)
    node = free_name("_node", df, "doc_id", "component_id")
    rows = durable(named.dropDuplicates([id_col, text_col]).withColumn(node, F.monotonically_increasing_id()))
    linked = link_classes(rows, plan, node, text_col).select(F.col("doc_id").alias(node), F.col("component_id").alias("_component"))
    best = linked.join(rows.select(node, F.col(id_col).alias("_id")), node).groupBy("_component").agg(F.min(F.struct("_id", node))[node].alias(node))
    later = linked.select(node).join(best.select(node), node, "left_anti")
    return without(rows, node, later, plan).drop(node).unionByName(rest)
