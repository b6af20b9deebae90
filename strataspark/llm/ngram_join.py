"""Operator 10, n-gram Jaccard self-join with a prefix tree over globally ordered n-gram sets.

Order. Every gram's number of sets is counted over the whole corpus (``tally``), and grams are ordered by it, rare ones
first. Two sets at the threshold share a gram among the first n - ceil(t n) + 1 of either, so only those of them that
another set holds as well become postings: a passage that very many documents share comes last in the order and makes
no candidates, and most documents have no posting at all.

Join. Nothing is closed over unverified candidates.

1. Each set with postings is verified against one representative, the least set that any of its postings has. Links are
   joined up by connected components. That settles groups of copies, however large, with one comparison per set.
2. A posting list whose sets do not all have one label yet is joined as it stands, with the labels known; lists of the
   same sets are joined once, and a pair that step 1 compared is not compared again.
3. Components follow from the verified links. For counts of links the sets of each component meet once more.

A list, or component, of more than about ``TASK_GRAMS`` grams is dealt into blocks that meet pairwise, each in a task
of its own. A task stores one side in a trie in descending order of gram frequency, walks it once with a vector of
partial overlaps of all probes, shared by every set below a node, and prunes a subtree when no probe can reach its
required overlap with the lengths that remain. Where only components are wanted, a subtree is also pruned when its sets
and all probes that may still link with them have one label already. Grams and sets are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import tally, words
from strataspark.llm.common import connected_components, dropped, fresh_name, slices, table, written

#: A similarity as a fraction, and words in a gram; production defaults.
SIMILARITY, GRAM = (80, 100), 5
#: Grams that one side of a task of the join holds, about.
TASK_GRAMS = 1_000_000
#: Sets that one task compares with one representative.
STAR_SETS = 256


def gram_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct gram hashes of a text's word hashes; all words as one gram if they are fewer than ``n``."""
    if not len(hashes):
        return hashes
    return np.unique(words.gram_hashes(hashes, min(n, len(hashes))))


def set_name(grams: np.ndarray) -> int:
    """A signed 64-bit hash of a set, from two sums over it."""
    sums = np.array([grams.sum(dtype=np.uint64), words.mix(grams).sum(dtype=np.uint64), len(grams)], np.uint64)
    return int(words.gram_hashes(words.mix(sums), 3).view(np.int64)[0])


def _texts_sets(texts_of: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, texts in slices(texts_of):
        hashes, first = words.word_hashes(texts, lower=True)
        for i in range(len(texts)):
            yield row + i, gram_set(hashes[first[i] : first[i + 1]], n)


def _summaries(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, tag, text) to (doc, tag, grams in its set, the set's name or null where it is empty)."""
    for batch in batches:
        sizes, names = [0] * batch.num_rows, [None] * batch.num_rows
        for row, grams in _texts_sets(batch.column(2), n):
            if len(grams):
                sizes[row], names[row] = len(grams), set_name(grams)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64())], names=["doc", "tag", "n_shingles", "set"])


def _once(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Of a task's rows that agree in the first ``keys`` columns the first one."""
    seen: set[tuple] = set()
    for batch in batches:
        keep = []
        for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True)):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def _slice_sets(part: pa.Table, n: int) -> list[np.ndarray]:
    """The distinct sets of a slice, in order of their first text."""
    found = {}
    for chunk in part.column("text").chunks:
        for _, grams in _texts_sets(chunk, n):
            if len(grams):
                found.setdefault(set_name(grams), grams)
    return found


def _sent(part: pa.Table, n: int, buckets: int) -> pa.Table:
    found = _slice_sets(part, n)
    keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found.values()]), return_counts=True)
    return tally.sent(part.column("slice")[0].as_py(), keys, counts, buckets)


_POSTINGS = pa.schema([("gram", pa.int64()), ("set", pa.int64()), ("n", pa.int64())])


def prefix_of(grams: np.ndarray, sets: np.ndarray, num: int, den: int) -> np.ndarray:
    """The grams of a set's prefix that more than one set holds: first come those that the fewest ``sets`` hold."""
    length = len(grams) - -(-num * len(grams) // den) + 1
    if np.count_nonzero(sets <= 1) >= length:
        return grams[:0]
    first = np.lexsort((grams, sets))[:length]
    return grams[first[sets[first] > 1]]


def _postings(part: pa.Table, answers: pa.Table, n: int, num: int, den: int, buckets: int) -> pa.Table:
    found = _slice_sets(part, n)
    flat = np.concatenate([np.zeros(0, np.uint64), *found.values()])
    keys, at = np.unique(flat, return_inverse=True)
    sets = tally.told(answers, keys, buckets)[at]
    out, done = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]], 0
    for name, grams in found.items():
        chosen = prefix_of(grams, sets[done : done + len(grams)], num, den)
        done += len(grams)
        if len(chosen):
            for column, value in zip(out, (chosen.view(np.int64), np.full(len(chosen), name), np.full(len(chosen), len(grams))), strict=True):
                column.append(value)
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=_POSTINGS)


def trie_links(stored: list[np.ndarray], probes: list[np.ndarray], num: int, den: int, settled: Callable[[list[int], np.ndarray], bool] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): the probes that reach the similarity with stored set i, by a walk over a trie of the stored sets.

    ``settled`` says of stored sets and probes whether no link between them is of interest any more.
    """
    flat = np.concatenate(stored) if stored else np.zeros(0, np.uint64)
    grams, inverse, frequency = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.empty(len(grams), np.int64)
    order[np.argsort(-frequency, kind="stable")] = np.arange(len(grams))
    cuts = np.cumsum([len(s) for s in stored])[:-1]
    sets = [np.sort(order[part]) for part in np.split(inverse, cuts)]
    # Postings: which probes hold each gram of the trie.
    lengths = np.array([len(p) for p in probes], np.int64)
    owner = np.repeat(np.arange(len(probes)), lengths)
    all_probes = np.concatenate(probes)
    at = np.minimum(np.searchsorted(grams, all_probes), len(grams) - 1)
    known = grams[at] == all_probes
    rank, owner = order[at[known]], owner[known]
    by_rank = np.argsort(rank, kind="stable")
    posting, posting_edge = owner[by_rank], np.searchsorted(rank[by_rank], np.arange(len(grams) + 1))

    def overlap(segment: np.ndarray) -> np.ndarray:
        parts = [posting[posting_edge[g] : posting_edge[g + 1]] for g in segment.tolist()]
        return np.bincount(np.concatenate(parts), minlength=len(probes)) if parts else 0

    keys = [s.astype(">u4").tobytes() for s in sets]
    rows = sorted(range(len(sets)), key=keys.__getitem__)
    size = np.array([len(sets[i]) for i in rows], np.int64)
    need_of = lambda n: -(-num * (lengths + n) // (num + den))
    # A node is a range of sorted sets that agree in their first ``depth`` grams.
    stack = [(0, len(rows), 0, np.zeros(len(probes), np.int64), np.arange(len(probes)))]
    while stack:
        lo, hi, depth, partial, viable = stack.pop()
        if settled and settled(rows[lo:hi], viable):
            continue
        first, last = sets[rows[lo]], sets[rows[hi - 1]]
        # Sorted order: what the outer two share, all between them share.
        m = min(len(first), len(last), int(size[lo:hi].min()))
        differ = np.flatnonzero(first[depth:m] != last[depth:m])
        common = depth + (int(differ[0]) if len(differ) else max(0, m - depth))
        partial = partial + overlap(first[depth:common])
        small, great = int(size[lo:hi].min()), int(size[lo:hi].max())
        viable = np.flatnonzero(np.minimum(partial + great - common, lengths) >= need_of(small))
        if not len(viable):
            continue  # nothing below can reach its required overlap
        while lo < hi and size[lo] == common:  # sets that end here
            linked = np.flatnonzero(partial >= need_of(common))
            if len(linked):
                yield rows[lo], linked
            lo += 1
        while lo < hi:
            token, end = sets[rows[lo]][common], lo + 1
            step = 1
            while end < hi and sets[rows[min(hi - 1, end + step - 1)]][common] == token:  # gallop, then walk
                end = min(hi, end + step)
                step *= 2
            while end < hi and sets[rows[end]][common] == token:
                end += 1
            stack.append((lo, end, common, partial, viable))
            lo = end


_LABELS = pa.schema([("set", pa.int64()), ("label", pa.int64()), ("links", pa.int64())])
_DEALT = "task long, side int, set long, label long, copies long"


def _joined(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, count_links: bool) -> Iterator[pa.RecordBatch]:
    """Rows (task, side, set, label, copies, text) sorted by them: a union-find label per set and its links. Side 2 meets itself.

    Without ``count_links`` the labels are the same, and links are no full counts.
    """

    def settle(held: list[tuple]) -> pa.RecordBatch:
        names = np.array([h[1] for h in held], np.int64)
        label = np.array([h[2] for h in held], np.int64)
        copies = np.array([h[3] for h in held], np.int64)
        side = np.array([h[0] for h in held])
        sets = [h[4] for h in held]
        links = np.zeros(len(names), np.int64)
        left = np.flatnonzero(side != 1)
        alone = bool((side == 2).all())
        probes = left if alone else np.flatnonzero(side == 1)

        def settled(stored: list[int], asked: np.ndarray) -> bool:
            own = label[left[stored]]
            return bool((own == own[0]).all() and (label[probes[asked]] == own[0]).all())

        pairs = trie_links([sets[x] for x in left], [sets[x] for x in probes], num, den, None if count_links else settled) if len(left) and len(probes) else ()
        for i, js in pairs:
            me, them = left[i], probes[js]
            if alone:
                them = them[them != me]
            else:
                links[them] += copies[me]
            links[me] += copies[them].sum()
            tied = np.unique(np.append(label[them], label[me]))
            if len(tied) > 1:
                label[np.isin(label, tied)] = tied[0]
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(label), pa.array(links)], schema=_LABELS)

    task, held = None, []
    for batch in batches:
        tasks, sides, names, labels, copies = (batch.column(i).to_pylist() for i in range(5))
        for row, grams in _texts_sets(batch.column(5), n):
            if tasks[row] != task and held:
                yield settle(held)
                held = []
            task = tasks[row]
            if not held or held[-1][:2] != (sides[row], names[row]):  # a text may come from several tasks of the input
                held.append((sides[row], names[row], labels[row], copies[row], grams))
    if held:
        yield settle(held)


def _blocks(members: DataFrame, group: str, task_grams: int) -> DataFrame:
    """(group, set, label, copies, n) to ``_DEALT``: the sets of a group in tasks of at most about ``task_grams`` a side."""
    sizes = members.groupBy(group).agg(F.ceil(F.sum("n") / F.lit(task_grams)).cast("long").alias("blocks"))
    placed = members.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("set", F.lit(9)), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    return placed.select(group, "set", "label", "copies", "block", other).select(
        F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other")).alias("task"),
        F.when(F.col("block") == F.col("other"), 2).otherwise((F.col("block") > F.col("other")).cast("int")).alias("side"),
        "set", "label", "copies",
    )


def _stars(star: DataFrame, task_grams: int) -> DataFrame:
    """(set, low, n) to ``_DEALT``: each set against its representative, which goes to every block of its sets. Blocks
    are small, as one more costs one more copy of the representative only."""
    size = F.greatest(F.sum("n") / F.lit(max(1, task_grams // 32)), F.count("*") / F.lit(STAR_SETS))
    sizes = star.groupBy("low").agg(F.ceil(size).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("set", F.lit(9)), F.col("blocks"))
    one = F.lit(1).cast("long").alias("copies")
    probes = star.join(sizes, "low").select(F.xxhash64("low", block).alias("task"), F.lit(1).alias("side"), "set", F.col("set").alias("label"), one)
    heads = sizes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return probes.union(heads.select(F.xxhash64("low", "block").alias("task"), F.lit(0).alias("side"), F.col("low").alias("set"), F.col("low").alias("label"), one))


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = GRAM, similarity: tuple[int, int] = SIMILARITY, task_grams: int = TASK_GRAMS, count_links: bool = True) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, n_links); without ``count_links`` the first three.

    Sets: distinct n-word grams of the text with A-Z lower-cased; with fewer words, the whole sequence as one; null
    and blank texts have the empty set and are linked with nothing. Two documents link when den * intersection >= num
    * union. component_id is the least doc_id reachable; n_links counts the other rows linked. Rows of one id are one
    document with several texts; a row with a null id takes no part and has a null component. A text of any length is
    one set, held whole by the task that reads it; other columns of ``docs`` are ignored, an empty table gives no rows.
    """
    num, den = similarity
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(F.col(text).cast("string")).alias("tag"), F.col(text).cast("string").alias("text"))
    every = written(source.mapInArrow(lambda parts: _summaries(parts, n), "doc long, tag long, n_shingles long, set long"))
    taking = every.where("set is not null and doc is not null")
    classes = written(taking.groupBy("set").agg(F.min(F.struct("doc", "tag")).alias("rep"), F.count("*").alias("copies"), F.max("n_shingles").alias("n")).select("set", F.col("rep.doc").alias("doc"), F.col("rep.tag").alias("tag"), "copies", "n"))
    total = classes.agg(F.sum("n")).head()[0] or 0
    buckets = max(1, -(-total // tally.SLICE_KEYS))

    known = source.where("doc is not null and text is not null")
    texts = known.select("tag", "text").mapInArrow(lambda parts: _once(parts, 1), "tag long, text string").select(F.pmod("tag", F.lit(buckets)).alias("slice"), "text")
    answers = texts.groupBy("slice").applyInArrow(lambda t: _sent(t, n, buckets), tally.SENT).groupBy("bucket").applyInArrow(tally.answered, tally.ANSWER)
    listed = texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(lambda t, a: _postings(t, a, n, num, den, buckets), "gram long, set long, n long")
    postings = written(listed.distinct())

    lists = written(postings.groupBy("gram").agg(F.min("set").alias("low"), F.max("set").alias("high"), F.count("*").alias("sets")).where("low < high"))
    members = postings.join(lists, "gram")
    star = written(members.groupBy("set", "n").agg(F.min("low").alias("low")))
    wanted = star.select("set").join(classes.select("set", "doc", "tag"), "set")
    found = known.join(wanted, ["doc", "tag"]).select("set", "text").mapInArrow(lambda parts: _once(parts, 1), "set long, text string")
    candidates = written(found)

    def joined(dealt: DataFrame, links: bool = False) -> DataFrame:
        rows = dealt.join(candidates, "set").select("task", "side", "set", "label", "copies", "text")
        ordered = rows.repartition("task").sortWithinPartitions("task", "side", "set")
        return written(ordered.mapInArrow(lambda parts: _joined(parts, n, num, den, links), "set long, label long, links long"))

    first = joined(_stars(star.where("low < set"), task_grams)).where("label <> set")
    near = connected_components(first.select(F.col("set").alias("a"), F.col("label").alias("b")))
    labels = star.join(near.withColumnRenamed("node", "set"), "set", "left").select("set", F.col("low").alias("met"), F.coalesce("component", "set").alias("label"))
    labelled = written(members.join(labels, "set").select("gram", "set", "n", "label", F.lit(1).cast("long").alias("copies"), ((F.col("sets") == 2) & (F.col("set") == F.col("high")) & (F.col("met") == F.col("low"))).alias("met")))
    same = ["sets", "sum", "least"]
    open_lists = labelled.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("met").alias("met"), F.count("*").alias("sets"), F.sum(F.xxhash64("set").cast("decimal(20,0)")).alias("sum"), F.min("set").alias("least"))
    unsettled = written(open_lists.where("a < b and not met").groupBy(*same).agg(F.min("gram").alias("gram")).select("gram"))
    second = joined(_blocks(labelled.join(unsettled, "gram").drop("met"), "gram", task_grams)).where("label <> set")

    several = taking.groupBy("doc").agg(F.min("set").alias("b"), F.max("set").alias("most")).where("b < most")
    own = taking.join(several, "doc").where("set <> b").select(F.col("set").alias("a"), "b")
    ties = first.union(second).select(F.col("set").alias("a"), F.col("label").alias("b")).union(own)
    components = connected_components(ties).withColumnRenamed("node", "set")
    heads = written(components.join(classes.select("set", "doc", "copies", "n"), "set"))
    least = written(heads.groupBy("component").agg(F.min("doc").alias("head")))
    headed = written(heads.join(least, "component").select("set", F.col("component").alias("label"), "copies", "n", "head"))
    named = classes.select("set", "doc", "copies").join(headed.select("set", "head"), "set", "left").select("set", F.coalesce("head", "doc").alias("component_id"), "copies")
    columns = [F.col("doc").alias("doc_id"), "n_shingles", F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id")]
    if not count_links:
        out = every.join(written(named.select("set", "component_id")), "set", "left").select(*columns)
    else:
        meeting = headed.join(candidates.select("set").distinct(), "set", "left_semi")
        linked = joined(_blocks(meeting, "label", task_grams), links=True).groupBy("set").agg(F.sum("links").alias("links"))
        per_set = written(named.join(linked, "set", "left").select("set", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
        out = every.join(per_set, "set", "left").select(*columns, F.when(F.col("doc").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links"))
    dropped(postings, lists, star, candidates, labelled, unsettled, heads, least)
    return out


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = GRAM, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id. Rows with a null id stay, rows of one id stay or go together."""
    found = jaccard_join(docs, doc_id, text, n, similarity, count_links=False)
    key = fresh_name(docs, "joined_doc")
    away = found.where("component_id < doc_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(away, F.col(doc_id) == F.col(key), "left_anti")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join(table(spark, sf_dir, "documents"), n=3, similarity=(90, 100))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), placed AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words
), grams AS (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, n, k, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) AS gram FROM placed
  ) WHERE k = 1 OR k <= n - 2
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1
), shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)
), reached AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), heads AS (SELECT doc_id, min(other) AS head FROM reached GROUP BY 1
), counts AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(head, doc_id))::BIGINT AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN heads USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
