"""Parent–child links to full hierarchies, by pointer doubling.

Every round joins the pointers with themselves, so that after k rounds a
pointer spans 2^k links; depth d takes about log2(d) rounds, whatever the
number of rows. All tables are pairs, written to the shared folder between
rounds (never collected), and every join is an equi-join that AQE may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise

SEP = "/"


class Hierarchy:
    """Trees, and graphs with several parents, given by (id, parent) rows.

    edges: columns id, parent; rows with a null are ignored, repeated rows
    count once, parents that are no node must have been left out before.
    nodes: column id; a node without an edge is a root. Other columns, of
    whatever name, are not looked at. Empty tables give empty results.
    """

    def __init__(self, nodes: DataFrame, edges: DataFrame):
        self.nodes = nodes.select("id").filter("id IS NOT NULL").distinct()
        links = edges.select("id", "parent").filter("id IS NOT NULL AND parent IS NOT NULL").distinct()
        self.edges = materialise(links, "edges")
        self._reach: DataFrame | None = None
        self._open: DataFrame | None = None

    def _starts(self) -> DataFrame:
        return self.nodes.join(self.edges.select("id").distinct(), "id", "left_anti")

    def reach(self) -> DataFrame:
        """(id, root_id) for every root above each node. A root reaches itself.

        A node is unresolved if its pointers never run out: going up from it can
        lead into a circle. One all of whose ways end in circles has no row.

        Ends when neither the roots found nor the set of unresolved nodes
        changed in a round. Both are then final: of the nodes with the k-th
        longest way up some have exactly that, so the set shrinks in every
        round until only endless ways are left, and a root at distance d lies
        at distance d - 1 of the next node on the way.
        """
        if self._reach is None:
            # (id, up, done): pointers still to follow, and roots reached
            roots = self._starts().select("id", F.col("id").alias("up"), F.lit(True).alias("done"))
            links = self.edges.select("id", F.col("parent").alias("up"), F.lit(False).alias("done"))
            state, before = materialise(roots.unionByName(links), "reach"), None
            while True:
                size = state.agg(F.count_if("done"), F.count_distinct(F.when(~F.col("done"), F.col("id")))).first()
                if tuple(size) == before:
                    break
                before = tuple(size)
                a, b = state.filter("NOT done").alias("a"), state.alias("b")
                more = a.join(b, F.col("a.up") == F.col("b.id")).select("a.id", "b.up", "b.done")
                now = materialise(state.filter("done").unionByName(more).distinct(), "reach")
                discard(state)
                state = now
            self._open = state.filter("NOT done").select("id", "up")
            self._reach = state.filter("done").select("id", F.col("up").alias("root_id"))
        return self._reach

    def circles(self) -> DataFrame:
        """(id) of every node that is its own ancestor.

        Pointers that never run out end, after 2^k links, on circles or between
        two of them (and on ways longer than 2^k into one). Every node of a
        circle is such an end, so the closure of pairs is formed over the few
        nodes that are.
        """
        self.reach()
        ends = materialise(self._open.select(F.col("up").alias("id")).distinct(), "ends")
        kept = self.edges.join(ends, "id", "left_semi").join(ends.select(F.col("id").alias("parent")), "parent", "left_semi")
        return Hierarchy(ends, kept).ancestors().filter("id = ancestor_id").select("id")

    def ancestors(self) -> DataFrame:
        """(id, ancestor_id, distance) with the shortest distance, from 1 on.

        A node of a circle has itself as ancestor. Read the other way round,
        the rows are the descendants of ancestor_id.
        """
        jump = self.edges.select("id", F.col("parent").alias("up"))
        known = materialise(jump.select("id", F.col("up").alias("ancestor_id"), F.lit(1).alias("distance")), "known")
        span, before = 1, known.count()
        while True:
            far = jump.join(known.withColumnRenamed("id", "up"), "up").select(
                "id", "ancestor_id", (F.col("distance") + span).alias("distance")
            )
            now = materialise(
                known.unionByName(far).groupBy("id", "ancestor_id").agg(F.min("distance").alias("distance")), "known"
            )
            discard(known)
            known, after = now, now.count()
            if after == before:
                return known
            step = jump.alias("a").join(jump.alias("b"), F.col("a.up") == F.col("b.id"))
            jump, before, span = materialise(step.select("a.id", "b.up").distinct(), "jump"), after, span * 2

    def paths(self) -> DataFrame:
        """(id, root_id, path, depth): every way from a root down to a node.

        path joins the ids by ``/``, the root first. Nodes of circles, and
        links to or from them, are left out (``circles`` names them), so every
        way is finite; a node all of whose ways lead through a circle has none.
        A root has the path of its own id and depth 0.
        """
        ring = self.circles()
        free = self.nodes.join(ring, "id", "left_anti")
        links = self.edges.join(ring, "id", "left_anti").join(
            ring.select(F.col("id").alias("parent")), "parent", "left_anti"
        )
        done = materialise(
            self._starts().select("id", F.col("id").alias("root_id"), F.col("id").alias("path"), F.lit(0).alias("depth")),
            "paths",
        )
        # seg: the ids from just below up to id
        jump = materialise(links.join(free, "id", "left_semi").select("id", F.col("parent").alias("up"), F.col("id").alias("seg")), "segs")
        span = 1
        while not jump.isEmpty():
            more = jump.join(done.withColumnRenamed("id", "up"), "up").select(
                "id", "root_id", F.concat_ws(SEP, "path", "seg").alias("path"), (F.col("depth") + span).alias("depth")
            )
            now = materialise(done.unionByName(more), "paths")
            a, b = jump.alias("a"), jump.alias("b")
            step = materialise(
                a.join(b, F.col("a.up") == F.col("b.id")).select("a.id", "b.up", F.concat_ws(SEP, "b.seg", "a.seg").alias("seg")), "segs"
            )
            discard(done)
            discard(jump)
            done, jump, span = now, step, span * 2
        return done

    def summary(self) -> DataFrame:
        """(id, depth, max_depth, n_paths, n_roots, n_descendants, in_circle).

        depth and max_depth are those of the shortest and longest path, null
        for nodes without a path. A node counts once among its descendants'
        ancestors, itself left out.
        """
        ways = self.paths().groupBy("id").agg(
            F.min("depth").alias("depth"), F.max("depth").alias("max_depth"), F.count("*").alias("n_paths")
        )
        roots = self.reach().groupBy("id").agg(F.count("*").alias("n_roots"))
        below = (
            self.ancestors().filter("id <> ancestor_id").groupBy(F.col("ancestor_id").alias("id")).agg(F.count("*").alias("n_descendants"))
        )
        ring = self.circles().select("id", F.lit(True).alias("in_circle"))
        zero = {"n_paths": 0, "n_roots": 0, "n_descendants": 0, "in_circle": False}
        return self.nodes.join(ways, "id", "left").join(roots, "id", "left").join(below, "id", "left").join(ring, "id", "left").fillna(zero)
