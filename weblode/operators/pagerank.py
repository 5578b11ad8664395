"""Iterated PageRank without normalization: ``(1 - d) + d * sum of shares``.

Rank of a page without links is not passed on, so ranks sum to the number of
nodes only when every node has a link.

Two tables drive the loop. ``links(src, dst)`` is laid out by source once and
stays put, as a bucketed table on shared storage: ids are 8 bytes instead of
whole URLs (16 if two nodes would share one), and sources with more than ``LINKS_PER_SLOT`` links, if there are any,
are cut into slots so that no partition holds all of one. It is cached too, but
nothing depends on that: what a lost executor held is read again, bucket by
bucket, without a shuffle. ``state(id, out_degree, slots, rank)`` has a row
per node and is rewritten every step. A step shuffles one share per source to
the links, and what the targets receive, summed per target on the map side
first, so that a target of everybody's links is no burden.

With a folder for its state, a run notes every step it has made there, and one
that was broken off goes on after the last of them, in a new session too.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.files import Files
from weblode.functions.urls import website_id
from weblode.operators.skew import assign_slots, slots_needed
from weblode.scratch import remove, scratch_dir, stage, tidy

# Fixed values.
DAMPING = 0.85
ITERATIONS = 10

LINKS_PER_SLOT = 1_000_000
LINKS_PER_PARTITION = 4_000_000


def _node_id(url: str, wide: bool):
    """Null for a missing URL: its links carry no rank."""
    return F.unhex(website_id(F.col(url))) if wide else F.when(F.col(url).isNotNull(), F.xxhash64(url))


def _is_wide(nodes: DataFrame) -> bool:
    return dict(nodes.dtypes)["id"] == "binary"


def rank_nodes(
    edges: DataFrame,
    initial: DataFrame | None = None,
    links_per_slot: int = LINKS_PER_SLOT,
    wide: bool = False,
) -> DataFrame:
    """Node table ``(id, url, out_degree, slots, rank)`` from one scan of the
    edges. Sources start at rank 1, pure targets without one. Ids are 64-bit hashes
    of the URL, which two URLs may share, or ``wide`` ones."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("url"), F.lit(1).cast("bigint").alias("out")),
            F.struct(F.col("dst").alias("url"), F.lit(0).cast("bigint").alias("out")),
        )
    )
    nodes = edges.select(ends.alias("end")).groupBy(F.col("end.url").alias("url"))
    nodes = nodes.agg(F.sum("end.out").alias("out_degree"))
    if initial is None:
        rank = F.when(F.col("out_degree") > 0, F.lit(1.0))
    else:
        nodes = nodes.join(initial.select("url", "rank"), "url", "full")
        nodes = nodes.withColumn("out_degree", F.coalesce("out_degree", F.lit(0)))
        rank = F.coalesce("rank", F.when(F.col("out_degree") > 0, F.lit(1.0)))
    return nodes.select(
        _node_id("url", wide).alias("id"),
        "url",
        "out_degree",
        slots_needed("out_degree", links_per_slot).alias("slots"),
        rank.alias("rank"),
    )


def rank_links(edges: DataFrame, nodes: DataFrame, n_heavy: int) -> DataFrame:
    """Link table ``(src, dst)``, with ``slot`` if ``n_heavy`` sources need
    more than one."""
    wide = _is_wide(nodes)
    links = edges.select(_node_id("src", wide).alias("src"), _node_id("dst", wide).alias("dst"))
    heavy = nodes.where(F.col("slots") > 1).select(F.col("id").alias("src"), "slots")
    return assign_slots(links, "src", "dst", heavy, n_heavy)


def layout(links: DataFrame) -> list[str]:
    """Columns that links are partitioned by and joined on."""
    return [c for c in ("src", "slot") if c in links.columns]


def _dealt(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """The links dealt to buckets of their sources, and the number of buckets."""
    n_links, n_heavy = nodes.agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)), F.count_if(F.col("slots") > 1)
    ).first()
    buckets = max(
        int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-n_links // LINKS_PER_PARTITION),
    )
    links = rank_links(edges, nodes, n_heavy)
    return links.repartition(buckets, *layout(links)), buckets


def write_links(edges: DataFrame, nodes: DataFrame, path: str) -> dict:
    """Write the links as a table of buckets of their sources, so that no step
    has to shuffle them. Returns what it takes to read them again."""
    links, buckets = _dealt(edges, nodes)
    keys, name = layout(links), _table_name()
    # not sorted here: whoever reads the buckets sorts them, in memory
    bucketed = links.write.mode("overwrite").bucketBy(buckets, *keys)
    with tidy(edges.sparkSession):
        bucketed.option("path", path).saveAsTable(name)
    edges.sparkSession.sql(f"DROP TABLE {name}")  # an external one: its files stay
    return {"columns": {c: t for c, t in links.dtypes}, "keys": keys, "buckets": buckets}


def _table_name() -> str:
    return f"weblode_links_{uuid4().hex}"


def read_links(spark: SparkSession, path: str, links: dict) -> tuple[DataFrame, str]:
    """The links that ``write_links`` wrote, sorted here within their buckets, and the
    name of the table that says how they are laid out, which the caller drops."""
    name, keys = _table_name(), ", ".join(links["keys"])
    columns = ", ".join(f"{c} {t}" for c, t in links["columns"].items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {links['buckets']} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name).sortWithinPartitions(*links["keys"]), name


def lay_out(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links in the buckets that ``write_links`` writes, cached and not written: to
    drop a table empties the caches that read it, so this makes none. Filling the
    cache here lets the steps rely on its partitioning."""
    links, _ = _dealt(edges, nodes)
    links = links.sortWithinPartitions(*layout(links)).persist()
    links.count()
    return links


def pagerank_step(links: DataFrame, state: DataFrame, damping: float = DAMPING) -> DataFrame:
    """One step: the state with every node's rank renewed.

    Shares and node rows are summed together, so a node without in-links keeps
    its row and no join is needed to bring the two together.
    """
    keys = layout(links)
    shares = state.where((F.col("out_degree") > 0) & F.col("rank").isNotNull())
    share = (F.col("rank") / F.col("out_degree")).alias("share")
    if "slot" in keys:
        slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
        shares = shares.select(F.col("id").alias("src"), slot, share)
    else:
        shares = shares.select(F.col("id").alias("src"), share)
    received = links.join(shares, keys).select(F.col("dst").alias("id"), "share")
    own = state.select("id", F.lit(0.0).alias("share"), "out_degree", "slots")
    renewed = (
        own.unionByName(received, allowMissingColumns=True)
        .groupBy("id")
        .agg(
            F.max("out_degree").alias("out_degree"),
            F.max("slots").alias("slots"),
            F.sum("share").alias("received"),
        )
    )
    rank = (1 - damping) + damping * F.col("received")
    return renewed.select("id", "out_degree", "slots", rank.alias("rank"))


def _fingerprint(edges: DataFrame, initial: DataFrame | None, *settings: object) -> str:
    """Tells runs over other links, ranks or settings apart."""
    parts = [list(settings)]
    for rows, columns in ((edges, ("src", "dst")), (initial, ("url", "rank"))):
        if rows is not None:
            parts.append(list(rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*columns))).first()))
    return json.dumps(parts)


class _Steps:
    """The nodes, links and states of a run below one folder. States alternate
    between two places: one is read while the other is replaced. After each
    step a note with its number is put beside them, by a rename."""

    def __init__(self, spark: SparkSession, root: str, run: str | None):
        self.spark, self.root, self.run, self.files = spark, root, run, Files(spark, root)
        self.links: dict = {}

    def _note(self, step: int) -> str:
        return f"{self.root}/step-{step:06d}.json"

    def place(self, step: int) -> str:
        return f"{self.root}/state-{step % 2}"

    def last(self, most: int) -> int | None:
        """The last step of this run, if it is noted and not beyond ``most``."""
        if self.run is None or not self.files.exists(self.root):
            return None
        names = sorted(name for name, _ in self.files.names(self.root) if name.startswith("step-") and name.endswith(".json"))
        for name in reversed(names):
            note = json.loads(self.files.read(self.spark, f"{self.root}/{name}"))
            if note["run"] == self.run and note["step"] <= most:
                self.links = note["links"]
                return note["step"]
        return None

    def note(self, step: int) -> None:
        if self.run is not None:
            draft = f"{self.root}/draft-{uuid4().hex}"
            self.files.write(draft, json.dumps({"run": self.run, "step": step, "links": self.links}))
            self.files.rename(draft, self._note(step))

    def forget(self, step: int) -> None:
        """Before the state of a step is replaced."""
        if self.run is not None:
            self.files.delete(self._note(step))


def page_rank(
    edges: DataFrame,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    initial: DataFrame | None = None,
    links_per_slot: int = LINKS_PER_SLOT,
    state: str | None = None,
) -> DataFrame:
    """Ranks ``(url, rank)`` after a fixed number of steps.

    Each row of ``edges(src, dst)`` is one link. The edges are read twice, and
    once more with ``state``; pass a stored table. ``initial(url, rank)`` resumes
    from earlier ranks. With no step, only nodes with an initial rank are returned.

    ``state`` names a folder in which the run keeps its state. If a run over
    the same links with the same settings has left some there, it goes on from
    there, be it after a failure or to make more steps; other contents are
    replaced. The caller deletes the folder.
    """
    if iterations < 0:
        raise ValueError(f"iterations must not be negative: {iterations}")
    spark = edges.sparkSession
    run = _fingerprint(edges, initial, damping, links_per_slot) if state else None
    steps = _Steps(spark, state or scratch_dir(spark), run)
    done = steps.last(iterations)
    if done is None:
        remove(spark, steps.root)
        nodes = stage(rank_nodes(edges, initial, links_per_slot), f"{steps.root}/nodes")
        if not nodes.groupBy("id").count().where("count > 1").isEmpty():
            nodes = stage(rank_nodes(edges, initial, links_per_slot, wide=True), f"{steps.root}/nodes")
        now, done = nodes.drop("url"), 0
        if iterations:
            steps.links = write_links(edges, nodes, f"{steps.root}/links")
            steps.note(0)
    else:
        nodes = spark.read.parquet(f"{steps.root}/nodes")
        now = spark.read.parquet(steps.place(done)) if done else nodes.drop("url")
    if done < iterations:
        links, table = read_links(spark, f"{steps.root}/links", steps.links)
        links = links.persist()
        links.count()  # the steps can rely on the partitioning of a filled cache
        try:
            for step in range(done + 1, iterations + 1):
                steps.forget(step - 2)
                now = stage(pagerank_step(links, now, damping), steps.place(step))
                steps.note(step)
        finally:
            links.unpersist()
            spark.sql(f"DROP TABLE {table}")
    ranks = nodes.select("id", "url").join(now.select("id", "rank"), "id")
    ranks = stage(ranks.where(F.col("rank").isNotNull()).select("url", "rank"))
    if not state:
        remove(spark, steps.root)
    return ranks
