"""N-gram Jaccard join by token-combination prefixes.

A document's set holds the hashes of its distinct word n-grams, its tokens, in the order of those hashes. With similarity
t, at most ``e = n - ceil(t * n)`` of a set's n tokens are missing in a similar set, so the first ``e + 1`` tokens of
the two share one (the shorter prefix ends first; its tokens that the other has lie in the other's prefix too).

* Tokens are counted over all sets. A token in at most ``RARE`` sets is indexed by itself; all pairs under it that
  fit in length are compared, first by an upper bound from small sketches, then exactly.
* A more frequent token is not indexed by itself. Every prefix is longer than it need be, and a set with enough rare tokens
  in it drops the frequent ones: two such sets share a rare token or aren't similar. The other sets ("poor", mostly near copies
  in large groups) index combinations of two tokens, each with the next one of the set. A token that the other set lacks
  breaks two of them and one that only the other has breaks one. Both together are most where as many as possible are lacking
  (about ``2 * e``), so among one more of the first combinations of two similar sets one is shared: a prefix of combinations
  whose size grows with the set, not with its square, at any length. The rest of the sets only look up combinations
  that poor sets have, and only if the prefix longer by one holds two frequent tokens, as it must if no rare one is shared.
* Poor sets whose combinations lead to one set form a group. A group is cut into cells by length and hash; cells whose lengths
  fit meet in one task, first with sketches, then with the sets that these leave, and return links that span components.

Equal sets are one set throughout, and components are those of the graph of links, so a group of copies is never expanded.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginbook.llm.bits import bits_of, may
from marginbook.llm.components import components
from marginbook.llm.frames import LOWER, Scratch, groups_of, raw, small_batches, text_bytes
from marginbook.llm.words import WordHashes, mix, windows

#: Sets under one token up to which the token is indexed by itself.
RARE = 32
#: Sets in a cell of a group.
CELL = 512
SKETCH = 128
#: Parts that the sets of a large group are dealt in before they have a cell.
DEALT = 64
#: Bytes of text whose sets are built at a time.
SLICE = 4 << 20


def shingles(words: list[bytes], width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words; of the whole sequence if that is shorter."""
    if not words:
        return np.empty(0, np.int64)
    hashes = known.of(words)
    if len(words) < width:
        # Marked by the length, so a short sequence equals no n-gram.
        hashes = mix(windows(hashes, len(words)) + np.uint64(len(words)))
    else:
        hashes = mix(windows(hashes, width))
    return np.unique(hashes.view(np.int64))


def _set_id(tokens: np.ndarray) -> int | None:
    n = len(tokens)
    return int(mix(windows(tokens.view(np.uint64), n) + np.uint64(n)).view(np.int64)[0]) if n else None


def _sketch(tokens: np.ndarray) -> bytes:
    counts = np.bincount((tokens & (SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    if counts.max(initial=0) > 65535:
        counts[:] = 65535  # too large to bound: fits everything
    return counts.astype("<u2").tobytes()


class Rule:
    """The similarity ``100 * shared >= percent * union`` in whole numbers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def spare(self, n: np.ndarray | int) -> np.ndarray | int:
        """Tokens of a set of n that a similar set may lack."""
        return n - -(-self.percent * n // 100)

    def holds(self, shared, a, b):
        return 100 * shared >= self.percent * (a + b - shared)

    def depth(self, n: int) -> int:
        """Tokens of the indexed prefix: what is needed, one for combinations, and spare ones to replace frequent tokens."""
        need = self.spare(n) + 1
        return min(n, need + 1 + need // 2 + 4)

    def broken(self, n: int) -> int:
        """Most combinations of neighbours that a set of n can lose in a similar set."""
        shared = n - self.spare(n)
        return self.spare(n) + 100 * shared // self.percent - shared

    def kept(self, n: int) -> int:
        """Tokens of the kept prefix, enough for all the combinations to index."""
        return min(n, max(self.depth(n), self.broken(n) + 2))

    def combines(self) -> bool:
        """Whether two similar sets always share a combination; below about three quarters small sets may not."""
        return all(n >= self.broken(n) + 2 for n in range(max(2, self.least()), 400))

    def least(self) -> int:
        """Smallest set that can be similar to another one: n / (n + 1) must reach the similarity."""
        return -(-self.percent // (100 - self.percent))


def _first_pass(width: int, rule: Rule):
    least = rule.least()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in (b for held in groups_of(batches, text_bytes("text"), SLICE) for b in held):
            sizes, sids, prefixes, sketches = [], [], [], []
            for text in raw(batch.column("text")):
                tokens = shingles((text or b"").translate(LOWER).split(), width, known)
                n = len(tokens)
                sizes.append(n)
                sids.append(_set_id(tokens))
                prefixes.append(tokens[:rule.kept(n)] if n >= least else tokens[:0])
                sketches.append(_sketch(tokens) if n >= least else None)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sketches, pa.binary())],
                names=["doc", "n", "sid", "prefix", "sketch"])
    return run


def _asked(wanted: np.ndarray):
    """Keep the rows whose ``doc`` may be a wanted one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc").is_valid())
            yield batch.filter(pa.array(may(wanted, batch.column("doc").to_numpy().view(np.uint64))))
    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            keep, packed = [], []
            for text, sid in zip(raw(batch.column("text")), batch.column("sid").to_pylist(), strict=True):
                tokens = shingles((text or b"").translate(LOWER).split(), width, known)
                keep.append(_set_id(tokens) == sid)  # else another text of a repeated id
                if keep[-1]:
                    packed.append(tokens.tobytes())
            own = batch.select(["sid", "paired", "celled"]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(packed, pa.binary())],
                                             names=["sid", "paired", "celled", "tokens"])
    return run


def _could_hold(rule: Rule):
    """Keep the pairs whose sketches allow the similarity: no bucket shares more tokens than either has in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, SKETCH) for c in ("sa", "sb"))
            shared = np.minimum(a, b).sum(axis=1, dtype=np.int64)
            keep = rule.holds(shared, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _hold(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                keep.append(bool(rule.holds(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared tokens of every left and every right set, as products of 0/1 matrices over a slice of tokens at a time."""
    sets = left + right
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    ranked, owner = flat[order], owner[order]
    number = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
    twice = np.bincount(number)[number] > 1
    number, owner = number[twice], owner[twice]
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(number):
        return out
    number = np.cumsum(np.append(0, number[1:] != number[:-1]))
    for start in range(0, int(number[-1]) + 1, 4096):
        lo, hi = np.searchsorted(number, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[lo:hi], number[lo:hi] - start] = 1
        out += (part[:len(left)] @ part[len(left):].T).astype(np.int64)
    return out


def _spanning(links: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """Edges from the smallest name of each component of a boolean matrix of links to the others."""
    edges, fresh = [], np.ones(len(links), bool)
    for root in np.argsort(names).tolist():
        if not fresh[root]:
            continue
        fresh[root] = False
        ahead = [root]
        while ahead:
            for next_ in np.flatnonzero(links[ahead.pop()] & fresh).tolist():
                fresh[next_] = False
                edges.append((int(names[root]), int(names[next_])))
                ahead.append(next_)
    return edges


def _cells(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        """Links between two cells, or inside one: rows of side 0 and 1 with their packed sets."""
        table = table.combine_chunks()
        sids, sides = table.column("sid").to_numpy(), table.column("side").to_numpy()
        sets = [np.frombuffer(t, np.int64) for t in table.column("tokens").to_pylist()]
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        right = right if len(right) else left
        shared = _overlaps([sets[i] for i in left], [sets[i] for i in right])
        sizes = np.array([len(s) for s in sets])
        found = rule.holds(shared, sizes[left][:, None], sizes[right][None, :])
        links = np.zeros((len(sets), len(sets)), bool)
        links[np.ix_(left, right)] = found
        edges = _spanning(links | links.T, sids)
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})
    return run


def _cells_could(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        """The rows of two cells, or of one, whose sketches allow a link to any set they would meet."""
        sides, sizes = table.column("side").to_numpy(), table.column("n").to_numpy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(-1, SKETCH)
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        own = not len(right)
        right = left if own else right
        keep = np.zeros(len(sides), bool)
        for i in left.tolist():
            shared = np.minimum(sketches[i], sketches[right]).sum(axis=1, dtype=np.int64)
            fits = rule.holds(shared, sizes[i], sizes[right])
            if own:
                fits &= right != i
            keep[right[fits]] = True
            keep[i] |= bool(fits.any())
        return table.select(["task", "side", "sid"]).filter(pa.array(keep))
    return run


def _lengths_fit(rule: Rule, a: str, b: str) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {rule.percent} * greatest({a}, {b})")


def _spare(rule: Rule) -> Column:
    return F.expr(f"n - ({rule.percent} * n + 99) div 100")


def _rare_links(tokens: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Candidate pairs (a, b) that share a rare token, have fitting lengths and pass the sketches."""
    rare = tokens.where(F.col("sets") <= RARE)
    left = rare.select("token", F.col("sid").alias("a"), F.col("n").alias("na"))
    right = rare.select("token", F.col("sid").alias("b"), F.col("n").alias("nb"))
    pairs = (left.join(right, "token").where("a < b").where(_lengths_fit(rule, "na", "nb"))
             .select("a", "b", "na", "nb").distinct())
    sketched = (pairs.join(sets.select(F.col("sid").alias("a"), F.col("sketch").alias("sa")), "a")
                .join(sets.select(F.col("sid").alias("b"), F.col("sketch").alias("sb")), "b"))
    return sketched.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_could_hold(rule), "a long, b long")


def _compared(pairs: DataFrame, full: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    sets = full.where("paired")
    return (pairs.join(sets.select(F.col("sid").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tb")), "b")
            .select("a", "b", "ta", "tb").mapInArrow(_hold(rule), "a long, b long"))


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets with 16 bits of each token."""
    for batch in batches:
        short = [(np.frombuffer(t, np.int64) >> 7).astype(np.uint16).tobytes() for t in batch.column("tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(short, pa.binary())], names=["sid", "short"])


def _near(pairs: DataFrame, full: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that 16 bits of each token allow: a set shares no more tokens than it has of the other's short ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, bool)
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
                seen[y] = True
                keep.append(bool(rule.holds(int(seen[x].sum()), len(x), len(y))))
                seen[y] = False
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    short = full.where("paired").select("sid", "tokens").mapInArrow(_shorten, "sid long, short binary")
    return (pairs.join(short.select(F.col("sid").alias("a"), F.col("short").alias("xa")), "a")
            .join(short.select(F.col("sid").alias("b"), F.col("short").alias("xb")), "b")
            .select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long"))


def _depth(rule: Rule) -> Column:
    """``Rule.depth`` of column ``n``."""
    return F.expr("least(n, {need} + 1 + {need} div 2 + 4)".format(need=f"(n - ({rule.percent} * n + 99) div 100 + 1)"))


def _group_keys(tokens: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(sid, n, poor, keys): the combinations of the poor sets, and of those that look them up."""
    need = _spare(rule) + 1
    early = F.count(F.when(F.col("pos") <= need, 1))
    per_set = (tokens.where(F.col("sets") > RARE).groupBy("sid", "n")
               .agg(F.count(F.lit(1)).alias("frequent"), early.alias("early"))
               .where(F.col("early") >= (2 if rule.combines() else 1))
               .select("sid", (F.col("frequent") > _depth(rule) - need).alias("poor")))
    if rule.combines():
        broken = F.expr(f"n - 2 * (({rule.percent} * n + 99) div 100) + 100 * (({rule.percent} * n + 99) div 100) div {rule.percent}")
        with_next = F.slice("prefix", F.lit(1), F.least(F.col("n") - 1, broken + 1).cast("int"))
        keys = F.transform(with_next, lambda x, i: F.xxhash64(x, F.get("prefix", i + 1)))
    else:
        keys = F.slice("prefix", F.lit(1), need.cast("int"))
    return sets.join(per_set, "sid").select("sid", "n", "poor", keys.alias("keys"))


def _group_members(keyed: DataFrame) -> DataFrame:
    """(grp, sid, n, poor): the sets to compare within each group of poor sets."""
    poor = keyed.where("poor")
    # A key's group is the smallest set it leads to over two steps: nearly always one for a whole group of near copies,
    # and always one for all sets of the key.
    poor_keys = poor.select("sid", F.explode("keys").alias("key"))
    hubs = poor_keys.groupBy("key").agg(F.min("sid").alias("hub"))
    reached = poor_keys.join(hubs, "key").groupBy("sid").agg(F.min("hub").alias("hub"))
    grouped = (poor.join(reached, "sid").select("hub", F.explode("keys").alias("key"))
               .groupBy("key").agg(F.min("hub").alias("grp")))
    return (keyed.select("sid", "n", "poor", F.explode("keys").alias("key")).join(grouped, "key")
            .groupBy("grp", "sid").agg(F.max("n").alias("n"), F.max("poor").alias("poor")))


def _cell_rows(members: DataFrame, rule: Rule) -> DataFrame:
    """(task, side, sid): cells of a group that must meet."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / rule.percent)))).cast("long")
    banded = members.withColumn("band", band)
    sizes = banded.groupBy("grp", "poor", "band").agg(
        F.count(F.lit(1)).alias("sets"), F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"),
        F.min("n").alias("low"), F.max("n").alias("high"))
    # The sets of a large group are dealt by hash until they have a cell; the others have one cell.
    large = sizes.where("parts > 1").select("grp", "poor", "band", "parts", F.explode(
        F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("dealt"))
    placed = (banded.withColumn("dealt", F.pmod(F.xxhash64("sid", F.lit(1)), F.lit(DEALT)).cast("int"))
              .join(large, ["grp", "poor", "band", "dealt"], "left")
              .withColumn("cell", F.pmod(F.xxhash64("sid"), F.coalesce("parts", F.lit(1))).cast("int")))
    # A cell of poor sets meets the poor cells of its band and later ones, and all others, where any two lengths fit.
    cells = sizes.select("grp", "poor", "band", "sets", "low", "high",
                         F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("cell"))
    here = cells.where("poor").drop("poor")
    other = cells.select("grp", *[F.col(c).alias(f"{c}2") for c in ("poor", "band", "cell", "low", "high")])
    fit = f"100 * high >= {rule.percent} * low2 AND 100 * high2 >= {rule.percent} * low"
    meets = (here.join(other, "grp").where(fit)
             .where("NOT poor2 OR band2 > band OR (band2 = band AND cell2 >= cell)")
             .where("sets > 1 OR NOT poor2 OR band2 > band")  # a set alone in its cell has none to meet there
             .withColumn("task", F.xxhash64("grp", "band", "cell", "poor2", "band2", "cell2")))
    left = (placed.where("poor").join(meets.select("grp", "band", "cell", "task"), ["grp", "band", "cell"])
            .select("task", F.lit(0).alias("side"), "sid"))
    right = (placed.join(meets.where("NOT poor2 OR band2 <> band OR cell2 <> cell")
                         .select("grp", F.col("poor2").alias("poor"), F.col("band2").alias("band"),
                                 F.col("cell2").alias("cell"), "task"),
                         ["grp", "poor", "band", "cell"]).select("task", F.lit(1).alias("side"), "sid"))
    return left.unionByName(right)


def jaccard_links(docs: DataFrame, width: int, percent: int, doc_id: str, text: str,
                  scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(documents: ``doc``, ``n``, ``sid``; links: ``a``, ``b`` between sids, spanning every component).

    The links read the tables ``linked``, ``within`` and ``later`` of ``scratch``, the documents ``members``.
    """
    small_batches(docs.sparkSession)
    rule = Rule(percent)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    schema = "doc long, n long, sid long, prefix array<bigint>, sketch binary"
    first = scratch.keep("first", texts.mapInArrow(_first_pass(width, rule), schema))
    # One row per distinct set; null ids never stand for a set, as their texts can't be found again by id.
    sets = scratch.keep("sets", first.where("sketch IS NOT NULL AND doc IS NOT NULL").groupBy("sid").agg(
        F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch")))
    members = scratch.keep("members", first.select("doc", "n", "sid"))
    scratch.drop("first")
    emitted = sets.select("sid", "n", F.posexplode(F.slice("prefix", F.lit(1), _depth(rule).cast("int"))).alias("pos", "token"))
    # Counted where they lie: the tokens are dealt once, and those of a single set go no further. A set has a token once.
    tokens = scratch.keep("tokens", emitted.withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("sets > 1"))
    pairs = scratch.keep("pairs", _rare_links(tokens, sets, rule))
    # The prefixes, most of ``sets``, go once the keys are written.
    slim = scratch.keep("slim", sets.select("sid", "doc", "n", "sketch"))
    keyed = scratch.keep("keyed", _group_keys(tokens, sets, rule))
    scratch.drop("tokens", "sets")
    met = scratch.keep("met", _cell_rows(_group_members(keyed), rule))
    scratch.drop("keyed")
    cells = scratch.keep("cells", met.join(slim.select("sid", "n", "sketch"), "sid").groupBy("task")
                         .applyInArrow(_cells_could(rule), "task long, side int, sid long"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sid"), F.lit(True).alias("paired"), F.lit(False).alias("celled"))
    wanted = (ends.union(cells.select("sid", F.lit(False), F.lit(True)))
              .groupBy("sid").agg(F.max("paired").alias("paired"), F.max("celled").alias("celled")))
    chosen = scratch.keep("chosen", slim.select("sid", "doc").join(wanted, "sid"))
    scratch.drop("met", "slim")
    # Only texts that may be wanted are dealt by id, not all of them.
    asked = texts.mapInArrow(_asked(bits_of(chosen.select("doc"))), "doc long, text string")
    found = (asked.join(chosen, "doc").withColumn("_key", F.xxhash64("text"))
             .dropDuplicates(["doc", "sid", "_key"]).select("sid", "paired", "celled", "text"))
    full = scratch.keep("full", found.mapInArrow(_full_sets(width), "sid long, paired boolean, celled boolean, tokens binary"))
    scratch.drop("chosen")
    # A set meets the smallest of its pairs first; of the other pairs only those are compared that no link connects by then. So a
    # group of near copies deals each of its sets a few times, not once a pair, and the sets lie in one join's shuffles at a time.
    star = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    linked = scratch.keep("linked", _compared(star, full, rule))
    within = scratch.keep("within", cells.join(full.where("celled").select("sid", "tokens"), "sid").groupBy("task")
                          .applyInArrow(_cells(rule), "a long, b long"))
    roots = components(linked.union(within))
    rest = (pairs.join(star, ["a", "b"], "left_anti")
            .join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
            .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
            .where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b"))
    near = scratch.keep("near", _near(scratch.keep("rest", rest), full, rule))
    later = scratch.keep("later", _compared(near, full, rule))
    scratch.drop("pairs", "cells", "full", "rest", "near")
    return members, linked.union(within).union(later)


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Words are runs of anything but space and \\\\t to \\\\r after A-Z are lower-cased. A set holds the distinct n-grams of
    ``width`` words, or the whole sequence if it is shorter; documents whose sets have ``100 * shared >= percent * union``
    are linked, and ``component_id`` is the smallest id reachable by links. Null and empty texts have the set size 0 and are
    linked with nothing. Repeated rows are linked and both returned. A row without id gets its set size and a null
    component. An empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    members, links = jaccard_links(docs, width, percent, doc_id, text, scratch)
    roots = components(links)  # which reads the links once, into a table of its own
    scratch.drop("linked", "within", "later")
    placed = (members.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
              .select("doc", "n", F.coalesce("root", "sid").alias("root")))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("least"))
    return placed.join(least, "root", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNull(), None).otherwise(F.coalesce("least", "doc")).alias("component_id"))
