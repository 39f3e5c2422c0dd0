"""File identities, artifact lineage and graph checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import basename
from ..session import reliable_checkpoint, shared_folder


def inventory_diff(declared: DataFrame, observed: DataFrame, key: str = "path") -> DataFrame:
    """Full outer comparison of ``(path, sha256, bytes)`` inventories."""
    a = declared.select(key, F.col("sha256").alias("a_sha"), F.col("bytes").alias("a_bytes"), F.lit(True).alias("_a"))
    b = observed.select(key, F.col("sha256").alias("b_sha"), F.col("bytes").alias("b_bytes"), F.lit(True).alias("_b"))
    status = (
        F.when(F.col("_b").isNull(), "missing")
        .when(F.col("_a").isNull(), "unexpected")
        .when((F.col("a_sha") == F.col("b_sha")) & (F.col("a_bytes") == F.col("b_bytes")), "same")
        .otherwise("changed")
    )
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def artifacts(tasks: DataFrame) -> DataFrame:
    """Explode ``inputs``/``outputs`` maps (name -> struct sha256, bytes) to one row per artifact."""
    parts = [
        tasks.select("process", "label", F.lit(side).alias("side"), F.explode(column).alias("name", "identity"))
        for side, column in (("input", "inputs"), ("output", "outputs"))
    ]
    both = parts[0].unionByName(parts[1])
    return both.select(
        "process", "label", "side", basename(F.col("name")).alias("file"), "identity.sha256", "identity.bytes"
    )


def broken_edges(artifact_rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Declared hand-overs whose output and input are absent, ambiguous or differ.

    ``edges``: ``from_process, from_file, to_process, to_file``; both ends share ``label``. Artifacts meet
    the edges they belong to, and one group per label and edge tells what was found. Hand-overs without any
    artifact are looked for only in labels that met fewer than the declared ones, which are numbered once.
    """
    names = ["from_process", "from_file", "to_process", "to_file"]
    edge = F.struct(*names)
    identity = F.struct("sha256", "bytes")

    def end(side: str, prefix: str) -> DataFrame:
        declared = edges.select(F.col(f"{prefix}_process").alias("process"), F.col(f"{prefix}_file").alias("file"), edge.alias("edge")).distinct()
        found = artifact_rows.filter(F.col("side") == side).groupBy("process", "label", "file").agg(
            F.count(F.lit(1)).alias("n"), F.min(identity).alias("identity")
        )
        return found.join(declared, ["process", "file"]).select("label", "edge", F.lit(side).alias("side"), "n", "identity")

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    both = end("output", "from").unionByName(end("input", "to")).groupBy("label", "edge").agg(
        F.coalesce(of("output", "n"), F.lit(0)).alias("made"), F.coalesce(of("input", "n"), F.lit(0)).alias("read"),
        of("output", "identity").alias("made_as"), of("input", "identity").alias("read_as"),
    )
    rule = (
        F.when(F.col("made") != 1, "output_count")
        .when(F.col("read") != 1, "input_count")
        .when(F.col("made_as") != F.col("read_as"), "identity")
    )
    seen = both.select("label", "edge", rule.alias("rule"))
    # labels that met fewer hand-overs than are declared lack some altogether
    numbered = edges.select(edge.alias("edge")).distinct().withColumn("number", F.row_number().over(Window.orderBy("edge")))
    met = seen.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    labels = artifact_rows.select("label").distinct().join(met, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))
    absent = _lacking(labels, numbered.count(), "label").join(numbered, "number").join(seen.select("label", "edge"), ["label", "edge"], "left_anti")
    told = seen.filter("rule is not null").unionByName(absent.select("label", "edge", F.lit("output_count").alias("rule")))
    return told.select("label", *[F.col(f"edge.{c}").alias(c) for c in names], "rule")


def _lacking(counted: DataFrame, total: int, key: str) -> DataFrame:
    """``(key, number)`` with every number from 1 to ``total``, for keys whose count ``n`` is below it."""
    return counted.filter(F.col("n") < total).select(key, F.explode(F.sequence(F.lit(1), F.lit(max(1, total)))).alias("number"))


def asymmetric_inputs(observed: DataFrame, accepted: DataFrame, callers: DataFrame) -> DataFrame:
    """Every caller must have read exactly the accepted identities.

    Declared callers are counted per accepted identity; only identities that some caller did not read are
    spelt out. Reads of other identities, or by other callers, come from two anti joins.
    """
    reads = observed.select("sha256", "caller").distinct()
    wanted, named = accepted.select("sha256").distinct(), callers.select("caller").distinct()
    numbered = named.withColumn("number", F.row_number().over(Window.orderBy("caller")))
    proper = reads.join(wanted, "sha256", "left_semi").join(named, "caller", "left_semi")
    met = proper.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"))
    counted = wanted.join(met, "sha256", "left").select("sha256", F.coalesce("n", F.lit(0)).alias("n"))
    missing = _lacking(counted, numbered.count(), "sha256").join(numbered, "number").join(proper, ["sha256", "caller"], "left_anti")
    extra = reads.join(proper, ["sha256", "caller"], "left_anti")
    return missing.select("caller", "sha256", F.lit("not_read").alias("rule")).unionByName(extra.select("caller", "sha256", F.lit("not_accepted").alias("rule")))


def leaks(inputs: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Inputs of guarded tasks whose hash is on the forbidden list."""
    return inputs.join(forbidden.select("sha256").distinct(), "sha256", "left_semi")


def not_durable(outputs: DataFrame, objects: DataFrame) -> DataFrame:
    """Outputs without a durable object of the same hash and size that has a version."""
    stored = objects.select("sha256", F.col("bytes").alias("o_bytes"), F.col("version").alias("o_version"))
    best = stored.groupBy("sha256", "o_bytes").agg(F.max("o_version").alias("o_version"))
    joined = outputs.join(best, (outputs["sha256"] == best["sha256"]) & (outputs["bytes"] == best["o_bytes"]), "left").drop(best["sha256"])
    rule = F.when(F.col("o_bytes").isNull(), "absent").when(F.coalesce("o_version", F.lit("")).isin("", "null"), "unversioned")
    return joined.withColumn("rule", rule).filter("rule is not null").drop("o_bytes", "o_version")


def unknown_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose source or target is not a declared node."""
    known = nodes.select("node").distinct()
    source = edges.join(known.withColumnRenamed("node", "src"), "src", "left_anti").withColumn("side", F.lit("src"))
    target = edges.join(known.withColumnRenamed("node", "dst"), "dst", "left_anti").withColumn("side", F.lit("dst"))
    return source.unionByName(target).select("src", "dst", "side")


#: Jumps are composed as long as the composed ones are at most this many times the edges.
MOST_JUMPS = 4


def _written(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    A checkpoint keeps the size that the optimizer guessed for its plan. A join's guess is the product of its
    inputs' sizes, so a table joined to itself every round would double the digits of that number every round.
    """
    path = f"{shared_folder(df.sparkSession)}/jumps-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Jumps:
    """Pairs of nodes that a walk of exactly ``length`` edges joins; ``double`` composes them with themselves.

    A node with many ways in and out would multiply pairs, so the number of compositions is counted first:
    beyond ``MOST_JUMPS`` times the edges the length stays, and callers go on by jumps of that length.
    """

    def __init__(self, edges: DataFrame) -> None:
        self.pairs, self.length, self._ends = _written(edges.select("src", "dst").distinct()), 1, None
        self.edges = self.pairs.count()
        self._measure()

    def _measure(self) -> None:
        """Count compositions, and the nodes that walks of this length start from and lead to.

        Longer walks have no other ends than shorter ones. If twice the length has as many, then so has every
        length: ``settled`` says that these are the ends of the walks without end.
        """
        ways = F.explode(F.array(F.struct(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")), F.struct(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"))))
        nodes = self.pairs.select(ways.alias("w")).select("w.*").filter("node is not null").groupBy("node").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
        made = F.coalesce(F.sum(F.col("i").cast("decimal(19,0)") * F.col("o")), F.lit(0))
        self._made, *ends = nodes.agg(made, F.count_if(F.col("i") > 0), F.count_if(F.col("o") > 0)).first()
        self.settled, self._ends = ends == self._ends, ends

    def double(self) -> bool:
        if not 0 < self._made <= MOST_JUMPS * self.edges:
            return False
        first, second = self.pairs.select("src", F.col("dst").alias("via")), self.pairs.select(F.col("src").alias("via"), "dst")
        self.pairs = _written(first.join(second, "via").select("src", "dst").distinct())
        self.length *= 2
        self._measure()
        return True


def _endless(pairs: DataFrame, near: str, far: str) -> DataFrame:
    """Nodes at the ``near`` end of walks without end over the pairs: peel those whose ``far`` end goes nowhere."""
    left, size = pairs, pairs.count()
    while size:
        kept = reliable_checkpoint(left.join(left.select(F.col(near).alias(far)).distinct(), far, "left_semi").select("src", "dst"))
        now = kept.count()
        left, before, size = kept, size, now
        if now == before:
            break
    return left.select(F.col(near).alias("node")).distinct()


def cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges left after peeling nodes that have no way in or no way out.

    Empty exactly when the graph is acyclic: an edge stays if walks without end lead to its source and from
    its target. Jumps double in length until there are none (no cycle) or their ends are those of the walks
    without end, so n edges to peel in a row take about log2(n) rounds; where jumps would multiply, peeling
    rounds follow.
    """
    jumps = _Jumps(edges)
    all_edges = jumps.pairs
    while not jumps.settled and jumps.double():
        pass
    if not jumps.edges or jumps.pairs.isEmpty():
        return all_edges.limit(0)
    if jumps.settled:
        onward, back = [jumps.pairs.select(F.col(end).alias("node")).distinct() for end in ("src", "dst")]
    else:
        onward, back = _endless(jumps.pairs, "src", "dst"), _endless(jumps.pairs, "dst", "src")
    return all_edges.join(onward.withColumnRenamed("node", "dst"), "dst", "left_semi").join(back.withColumnRenamed("node", "src"), "src", "left_semi").select("src", "dst")


def ancestors(edges: DataFrame, start: DataFrame) -> DataFrame:
    """All nodes reachable from the start nodes along edges, with the fewest steps.

    After each round the nodes within twice as many steps are known: jumps of length n lead from those at
    most n steps behind the farthest to all that are up to n steps farther.
    """
    jumps = _Jumps(edges)
    reached = start.select(F.col("node"), F.lit(0).alias("steps")).distinct()
    known = 0
    while jumps.edges:
        frontier = reached.filter(F.col("steps") > known - jumps.length).withColumnsRenamed({"node": "src", "steps": "_from"})
        found = (
            jumps.pairs.join(frontier, "src")
            .groupBy(F.col("dst").alias("node")).agg((F.min("_from") + jumps.length).cast("int").alias("steps"))
            .join(reached.select("node"), "node", "left_anti")
        )
        new = _written(found)
        if new.isEmpty():
            break
        reached = reached.unionByName(new)
        known += jumps.length
        jumps.double()
    return reached


def reference_agreement(references: DataFrame, key: str = "name") -> DataFrame:
    """Cross-links: one identity per referenced name, whoever refers to it."""
    return references.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("sha256") == F.max("sha256")) & (F.min("bytes") == F.max("bytes"))).alias("agrees"),
    )


def declared_sizes(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Total declared bytes and how many entries do not state a size."""
    return manifest.groupBy(*keys).agg(
        F.sum(F.coalesce("bytes", F.lit(0))).alias("bytes"), F.count_if(F.col("bytes").isNull()).alias("unknown_sizes")
    )
