"""DuckDB SQL, generated by Python, for the point/clustering queries.

The iterative algorithms (farthest-first traversal, greedy cover over the guess
ladder) are unrolled into CTE chains, one CTE per step/round, with the same
parameters as the Spark side. The distance is the same left-to-right sum of
squared differences, so values are bit-identical between the engines.
"""

from __future__ import annotations


def dist(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(range(1, len({a}) + 1), "
            f"lambda _i: ({a}[_i] - {b}[_i]) * ({a}[_i] - {b}[_i])), "
            f"lambda _s, _v: _s + _v))")


PT2_SQL = ("SELECT CAST(c_custkey AS BIGINT) AS point_id, "
           "[c_acctbal / 1000.0, CAST(c_nationkey AS DOUBLE)]::DOUBLE[] AS point FROM customer")
PEV_SQL = "SELECT CAST(event_id AS BIGINT) AS point_id, [value]::DOUBLE[] AS point FROM events"
PT64_SQL = ("SELECT CAST(vec_id AS BIGINT) AS point_id, CAST(embedding AS DOUBLE[]) AS point "
            "FROM embeddings")


def fft_ctes(tag: str, pts: str, n_centers: int, parts: int, weight: str = "1") -> tuple[list[str], str]:
    """CTEs for the per-partition traversal over relation ``pts(point_id, point)``, each point of the given weight.
    Returns (ctes, name of the final state relation with part_id, point_id, point,
    weight, mind, near, chosen)."""
    L = int(parts)
    ctes = [
        f"{tag}_p AS (SELECT CAST(((point_id % {L}) + {L}) % {L} AS INTEGER) AS part_id, "
        f"point_id, point, CAST({weight} AS BIGINT) AS weight FROM {pts})",
        f"{tag}_c0 AS (SELECT p.part_id, p.point_id AS cid, p.point AS cpt FROM {tag}_p p "
        f"JOIN (SELECT part_id, min(point_id) AS cid FROM {tag}_p GROUP BY part_id) f "
        f"ON f.part_id = p.part_id AND f.cid = p.point_id)",
    ]
    d0 = dist("p.point", "c.cpt")
    ctes.append(
        f"{tag}_s0 AS (SELECT p.part_id, p.point_id, p.point, p.weight, {d0} AS mind, "
        f"0 AS near, CASE WHEN p.point_id = c.cid THEN 0 END AS chosen "
        f"FROM {tag}_p p JOIN {tag}_c0 c USING (part_id))")
    for s in range(1, n_centers):
        prev = f"{tag}_s{s - 1}"
        ctes.append(
            f"{tag}_c{s} AS (SELECT part_id, point_id AS cid, point AS cpt FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY mind DESC, point_id) "
            f"AS rn FROM {prev} WHERE mind > 0) WHERE rn = 1)")
        d = dist("p.point", "c.cpt")
        closer = f"(c.cid IS NOT NULL AND {d} < p.mind)"
        ctes.append(
            f"{tag}_s{s} AS (SELECT p.part_id, p.point_id, p.point, p.weight, "
            f"CASE WHEN {closer} THEN {d} ELSE p.mind END AS mind, "
            f"CASE WHEN {closer} THEN {s} ELSE p.near END AS near, "
            f"CASE WHEN p.point_id = c.cid THEN {s} ELSE p.chosen END AS chosen "
            f"FROM {prev} p LEFT JOIN {tag}_c{s} c USING (part_id))")
    return ctes, f"{tag}_s{n_centers - 1}"


def coreset_ctes(tag: str, pts: str, n_centers: int, parts: int, weight: str = "1") -> tuple[list[str], str]:
    ctes, final = fft_ctes(tag, pts, n_centers, parts, weight)
    ctes.append(f"{tag}_w AS (SELECT part_id, near AS step, CAST(sum(weight) AS BIGINT) AS weight "
                f"FROM {final} GROUP BY part_id, near)")
    ctes.append(f"{tag}_core AS (SELECT s.part_id, CAST(s.chosen AS INTEGER) AS step, s.point_id, "
                f"s.point, w.weight FROM {final} s JOIN {tag}_w w "
                f"ON w.part_id = s.part_id AND w.step = s.chosen WHERE s.chosen IS NOT NULL)")
    return ctes, f"{tag}_core"


def solver_ctes(tag: str, P: str, k: int, z: int, alpha: int) -> tuple[list[str], dict]:
    """CTEs for the greedy solver over ``P(idx, point_id, point, weight)``."""
    c1, c2 = float(1 + 2 * alpha), float(3 + 4 * alpha)
    K = k + z + 1
    dab = dist("a.point", "b.point")
    ctes = [
        f"{tag}_head AS (SELECT * FROM {P} ORDER BY idx LIMIT {K})",
        f"{tag}_hmin AS (SELECT min(d) AS hmin FROM (SELECT {dab} AS d FROM {tag}_head a "
        f"JOIN {tag}_head b ON a.idx < b.idx) WHERE d > 0)",
        f"{tag}_amin AS (SELECT min(d) AS amin FROM (SELECT {dab} AS d FROM {P} a "
        f"JOIN {P} b ON a.idx < b.idx) WHERE d > 0)",
        f"{tag}_first AS (SELECT point FROM {tag}_head ORDER BY idx LIMIT 1)",
        f"{tag}_stats AS (SELECT count(*) AS m, CAST(sum(p.weight) AS BIGINT) AS total_weight, "
        f"max({dist('p.point', 'f.point')}) AS reach FROM {P} p, {tag}_first f)",
        f"{tag}_r0 AS (SELECT m, total_weight, CASE WHEN m = 1 THEN CAST('inf' AS DOUBLE) "
        f"WHEN hmin IS NOT NULL THEN hmin / 2 WHEN amin IS NOT NULL THEN amin / 2 "
        f"ELSE 0.0 END AS r0, 2.0 * reach AS dbound FROM {tag}_stats, {tag}_hmin, {tag}_amin)",
        f"{tag}_G AS (SELECT *, CASE WHEN r0 = 0 OR isinf(r0) OR dbound <= {c2} * r0 THEN 1 "
        f"ELSE 2 + greatest(0, CAST(ceil(log2(dbound / ({c2} * r0))) AS INTEGER)) END AS G "
        f"FROM {tag}_r0)",
        f"{tag}_lad AS (SELECT CAST(t.g AS INTEGER) AS g, r0 * pow(2.0, t.g - 1) AS r "
        f"FROM {tag}_G, generate_series(1, G) AS t(g))",
        f"{tag}_u0 AS (SELECT l.g, l.r, p.idx, p.point_id, p.point, p.weight "
        f"FROM {tag}_lad l, {P} p)",
    ]
    for t in range(1, k + 1):
        dcu = dist("c.point", "u.point")
        ctes.append(
            f"{tag}_bw{t} AS (SELECT l.g, c.idx, c.point_id, c.point, CAST(sum(u.weight) AS BIGINT) AS bw "
            f"FROM {tag}_lad l CROSS JOIN {P} c JOIN {tag}_u{t - 1} u "
            f"ON u.g = l.g AND {dcu} <= CAST({c1} AS DOUBLE) * l.r "
            f"GROUP BY l.g, c.idx, c.point_id, c.point)")
        ctes.append(
            f"{tag}_c{t} AS (SELECT g, idx, point_id, point, {t - 1} AS center_no FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY g ORDER BY bw DESC, idx) AS rn "
            f"FROM {tag}_bw{t} WHERE bw > 0) WHERE rn = 1)")
        ctes.append(
            f"{tag}_u{t} AS (SELECT u.* FROM {tag}_u{t - 1} u LEFT JOIN {tag}_c{t} c "
            f"ON c.g = u.g WHERE c.g IS NULL OR {dcu} > CAST({c2} AS DOUBLE) * u.r)")
    ctes.append(
        f"{tag}_left AS (SELECT l.g, coalesce(sum(u.weight), 0) AS wz FROM {tag}_lad l "
        f"LEFT JOIN {tag}_u{k} u ON u.g = l.g GROUP BY l.g)")
    ctes.append(f"{tag}_best AS (SELECT min(g) AS g FROM {tag}_left WHERE wz <= {z})")
    union = " UNION ALL ".join(f"SELECT * FROM {tag}_c{t}" for t in range(1, k + 1))
    ctes.append(
        f"{tag}_centers AS (SELECT CAST(center_no AS INTEGER) AS center_no, point_id, point "
        f"FROM ({union}) WHERE g = (SELECT g FROM {tag}_best))")
    ctes.append(
        f"{tag}_report AS (SELECT CAST({k} AS INTEGER) AS k, CAST({z} AS INTEGER) AS z, "
        f"CAST({alpha} AS INTEGER) AS alpha, r.m AS n_points, r.total_weight, "
        f"r.r0 AS initial_guess, r.r0 * pow(2.0, b.g - 1) AS final_guess, "
        f"CAST(b.g AS INTEGER) AS n_guesses, "
        f"CAST((SELECT count(*) FROM {tag}_centers) AS INTEGER) AS n_centers "
        f"FROM {tag}_r0 r, {tag}_best b)")
    names = {"centers": f"{tag}_centers", "report": f"{tag}_report", "lad": f"{tag}_lad",
             "r0": f"{tag}_r0"}
    return ctes, names


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
