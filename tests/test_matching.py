import random
from collections import deque

import pytest
from helpers import rows

from roispark.functions import bits
from roispark.operators import identity, matching, metrics, overlap


def fifo(edges):
    """Plain deferred acceptance: the definition the distributed rounds must reproduce."""
    prefs = {}
    for a, b, s in edges:
        prefs.setdefault(a, []).append((-s, b))
    for a in prefs:
        prefs[a].sort()
    queue, at, held = deque(sorted(prefs)), dict.fromkeys(prefs, 0), {}
    while queue:
        a = queue.popleft()
        if at[a] >= len(prefs[a]):
            continue
        s, b = prefs[a][at[a]]
        at[a] += 1
        if b not in held:
            held[b] = (a, -s)
        elif -s > held[b][1]:
            queue.append(held[b][0])
            held[b] = (a, -s)
        else:
            queue.append(a)
    return {(a, b) for b, (a, _) in held.items()}


def random_groups(seed, groups=40):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        n, m, levels = rng.randint(1, 9), rng.randint(1, 8), rng.choice([1, 2, 3, 50])
        for a in range(1, n + 1):
            for b in range(1, m + 1):
                if rng.random() < 0.6:
                    out.append((g, a * 3, b, float(rng.randint(1, levels))))
    return out


def check(spark, edges, block):
    df = spark.createDataFrame(edges, "run_id long, object_a long, object_b long, score double")
    got = {}
    for g, a, b in rows(matching.stable_matching(df, ["run_id"], "score", block=block), "run_id", "object_a", "object_b"):
        got.setdefault(g, set()).add((a, b))
    for g in {e[0] for e in edges}:
        want = fifo([e[1:] for e in edges if e[0] == g])
        assert got.get(g, set()) == want, g


def test_rounds_equal_fifo(spark):
    check(spark, random_groups(1), matching.BLOCK)


@pytest.fixture
def pieces(spark):
    """Small partitions are not merged, so that the events of a B object lie in several pieces."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_split_events_equal_fifo(spark, pieces):
    check(spark, random_groups(2), 4)


def test_hot_partner_is_split_whatever_the_ids(spark, pieces):
    # One B object wanted by every A object; ids far apart and negative.
    ids = [(-1) ** a * a * 10**14 for a in range(1, 60)]
    edges = [(0, a, 1, float(n % 3)) for n, a in enumerate(ids)] + [(0, a, 2 + n % 5, 0.5) for n, a in enumerate(ids)]
    check(spark, edges, 7)


def test_long_chains_outlast_the_log(spark):
    # Every round displaces one holder, so the log is merged several times.
    n = 2 * matching.COMPACT + 3
    edges = [(0, a, b, float(100 - b if a == 0 else 10 * a - b)) for a in range(n) for b in range(n)]
    check(spark, edges, matching.BLOCK)


def test_no_edges(spark):
    df = spark.createDataFrame([], "run_id long, object_a long, object_b long, score double")
    assert matching.stable_matching(df, ["run_id"], "score").count() == 0


def test_matching_is_stable_and_one_to_one(spark):
    edges = random_groups(3)
    df = spark.createDataFrame(edges, "run_id long, object_a long, object_b long, score double")
    m = rows(matching.stable_matching(df, ["run_id"], "score"))
    assert len({(g, a) for g, a, *_ in m}) == len(m) == len({(g, b) for g, _, b, _ in m})
    by_a, by_b = {(g, a): s for g, a, _, s in m}, {(g, b): s for g, _, b, s in m}
    for g, a, b, s in edges:
        assert not (s > by_a.get((g, a), -1) and s > by_b.get((g, b), -1))


# --- golden fixture ------------------------------------------------------------
A = {101: [(x, 1) for x in range(1, 6)], 102: [(x, 1) for x in range(6, 11)], 103: [(x, 2) for x in range(1, 6)],
     104: [(x, 3) for x in range(1, 6)], 105: [(x, 4) for x in range(1, 6)]}
B = {201: [(x, 1) for x in range(1, 4)] + [(x, 3) for x in range(1, 6)], 202: [(x, 1) for x in range(1, 9)],
     203: [(1, 2), (2, 2)], 204: [(x, 4) for x in range(1, 6)]}
A_SOURCE = {k: v for k, v in A.items() if k != 104} | {106: A[105]}
A_CELL = {101: 11, 102: 12, 103: 13, 104: 999, 105: 15, 106: 16}
B_CELL = {201: 21, 202: 22, 203: 23, 204: 24}


def pixel_frame(spark, channels, keep=None):
    data = [("q", ch, o, x, y, cells.get(o)) for ch, objs, cells in channels for o, px in objs.items() for x, y in px
            if keep is None or o in keep]
    return spark.createDataFrame(data, "acquisition_id string, channel string, object_id long, x long, y long, cell_id long")


def golden(spark, keep=None):
    current = pixel_frame(spark, [("A", A, A_CELL), ("B", B, B_CELL)], keep)
    source = pixel_frame(spark, [("A", A_SOURCE, A_CELL), ("B", B, B_CELL)])
    mapping = spark.createDataFrame(
        [("q", "A", c, o, 9000 + i) for i, (o, c) in enumerate([(101, 11), (102, 12), (103, 13), (105, 15), (106, 16)], 1)]
        + [("q", "B", 20 + i, 200 + i, 9000 + i) for i in range(1, 5)],
        "acquisition_id string, channel string, cell_id long, marker_id long, nucleus_id long")
    keys = ["acquisition_id", "channel", "object_id"]
    cw, sw = bits.pack(current, keys), bits.pack(source, keys)
    o = overlap.mark_eligible(overlap.overlap_counts(cw, [("A", "B")]), 0.5)
    return current, cw, sw, mapping, o


def pairs(df):
    return set(rows(df, "object_a", "object_b"))


def test_golden_constraint(spark):
    current, cw, sw, mapping, o = golden(spark)
    assert {(r.object_a, r.object_b): r.a_percent_inside_b for r in o.collect()} == {
        (101, 201): 60.0, (101, 202): 100.0, (102, 202): 60.0, (103, 203): 40.0, (104, 201): 100.0, (105, 204): 100.0}
    free = matching.stable_matching(o.where("eligible"))
    assert pairs(free) == {(101, 202), (104, 201), (105, 204)}
    ids = identity.resolve_identities(cw, current, sw, mapping, "roi")
    status = {r.object_id: r.mapping_status for r in ids.collect()}
    assert status[101] == status[102] == status[103] == status[201] == "resolved"
    assert status[104] == "missing_coordinate_identity" and status[105] == "ambiguous_coordinate_identity"
    audit = identity.constraint_audit(o, ids)
    bound = matching.stable_matching(identity.constrained_eligible(o, audit).where("eligible"))
    assert pairs(bound) == {(101, 201), (102, 202)}
    final = {(r.object_a, r.object_b): r.exclusion_reason for r in identity.finish_audit(audit, bound).collect()}
    assert final[(101, 202)] == "different_canonical_nuclear_objectids"
    assert final[(103, 203)] == "below_directional_overlap_threshold"
    assert final[(104, 201)].startswith("unresolved_nuclear_assignment:A=missing_coordinate_identity")
    assert final[(105, 204)].startswith("unresolved_nuclear_assignment:A=ambiguous_coordinate_identity")
    assert final[(101, 201)] == final[(102, 202)] == ""
    details = identity.compare_pairs(audit, free, bound)
    assert pairs(details.where("nuclear_identity_discordant AND in_unconstrained")) == {(101, 202)}
    roi = metrics.object_areas(cw).groupBy("acquisition_id").count().selectExpr(
        "acquisition_id", "'A' AS channel_a", "'B' AS channel_b", "5L AS a_rois", "4L AS b_rois")
    summary = {r.metric: r.value for r in identity.compare_variants(audit, details, roi).collect()}
    assert len(summary) == 14 and summary["Final unconstrained stable matches"] == 3
    assert summary["Percent unconstrained final pairs with discordant nuclear identity"] == 100 / 3


def test_empty_constrained_result_is_valid(spark):
    current, cw, sw, mapping, o = golden(spark, keep={103, 203})
    audit = identity.constraint_audit(o, identity.resolve_identities(cw, current, sw, mapping, "roi"))
    assert [r.exclusion_reason for r in audit.collect()] == ["below_directional_overlap_threshold"]
    bound = matching.stable_matching(identity.constrained_eligible(o, audit).where("eligible"))
    assert bound.count() == 0
    acq = current.select("acquisition_id").distinct()
    empty = o.where("false")
    assert rows(overlap.pair_status(acq, empty, [("A", "B")]), "status") == [("no_overlap",)]
    assert rows(overlap.pair_status(acq, empty, [("A", "B")], constrained=True), "status") == [("ok",)]


def test_moved_nucleus_is_reported(spark):
    def nuclei(first_x):
        px = [("q", 9000 + i, first_x if i == 1 else i, 6) for i in range(1, 6)]
        return bits.pack(spark.createDataFrame(px, "acquisition_id string, object_id long, x long, y long"),
                         ["acquisition_id", "object_id"])

    context = spark.createDataFrame([("q", "DAPI", 12, 8, 0.5, 0.5)],
                                    "acquisition_id string, nuclear_name string, width long, height long, px double, py double")
    assert identity.context_violations(context, context, nuclei(1), nuclei(1)).count() == 0
    assert rows(identity.context_violations(context, context, nuclei(1), nuclei(9)), "check") == [("nuclear_segmentation",)]


def test_multiple_cell_ids_win_over_coordinates(spark):
    current, cw, sw, mapping, _ = golden(spark)
    split = current.selectExpr("acquisition_id", "channel", "object_id", "x", "y",
                               "CASE WHEN object_id = 101 AND x > 3 THEN 77 ELSE cell_id END AS cell_id",
                               "CASE WHEN object_id = 102 AND x > 8 THEN 5 ELSE object_id END AS roi")
    got = {r.object_id: r.mapping_status for r in identity.resolve_identities(cw, split, sw, mapping, "roi").collect()}
    assert got[101] == "multiple_CellID_values" and got[102] == "multiple_ROI_values"
