"""Clade naming over a derived tree in SQL, by full paths instead of pointer jumping."""

from __future__ import annotations

from workload.inputs import PARAMS, sql_double, sql_pick, sql_tree

LETTERS = ["'p__'", "'c__'", "'o__'", "'f__'", "'g__'"]


def sql_facts(tree: str) -> str:
    medians = [sql_double(red) for red in PARAMS[tree].medians]
    return f"""{sql_tree(tree)},
inner_nodes AS (
  SELECT node, parent, nongtdb_group = 'gtdb' AS gtdb, rank, "RED" AS red FROM nodes WHERE genome IS NULL),
facts AS (
  SELECT *, same AND closer AND n_int > 0 AS passed_over FROM (
    SELECT n.node, n.parent, n.gtdb, n.rank, n.node = n.parent AS is_root, p.rank AS top,
           NOT n.gtdb AND n.rank = p.rank AS same,
           abs(n.red - {sql_pick("n.rank", medians)}) <
             abs(CASE WHEN n.node = n.parent THEN 0e0 ELSE p.red END - {sql_pick("n.rank", medians)}) AS closer,
           coalesce(k.n_int, 0) AS n_int
    FROM inner_nodes n JOIN inner_nodes p ON n.parent = p.node
    LEFT JOIN (SELECT parent, count(*) AS n_int FROM inner_nodes WHERE NOT gtdb AND node <> parent GROUP BY parent) k
      ON k.parent = n.node)),
spans AS (
  SELECT node, parent, is_root, keeps, length, passed_over,
         CASE WHEN bears THEN first END AS first, CASE WHEN bears THEN last END AS last,
         bears AND NOT keeps AND length = 2 AS deferred
  FROM (
    SELECT *, NOT is_root AND NOT passed_over AND coalesce(first <= last, FALSE) AS bears FROM (
      SELECT *, CASE WHEN keeps THEN top WHEN length >= 2 THEN top + 1 END AS first, least(top + length - 1, 4) AS last
      FROM (
        SELECT f.node, f.parent, f.is_root, f.top, f.passed_over,
               NOT (p.same OR p.gtdb) OR p.closer AS keeps,
               CASE WHEN f.same THEN 1 ELSE f.rank - f.top END AS length
        FROM facts f JOIN facts p ON f.parent = p.node WHERE NOT f.gtdb)))),
bearing AS (SELECT node, first, last, deferred FROM spans WHERE first IS NOT NULL)"""


def sql_naming(tree: str) -> str:
    """CTEs up to ``final`` (genome, domain, anchor, a, n0..n4) and ``node_names``, ``genome_taxonomy``."""
    domain = PARAMS[tree].domain
    at_rank = ", ".join(
        f"arg_max(winner, distance) FILTER (first <= {r} AND last >= {r}) AS n{r}" for r in range(5)
    )
    own = " UNION ALL ".join(
        f"SELECT ord, {r} AS rank, CASE WHEN above < {r} THEN coalesce(n{r}, ord) ELSE n{r} END AS name, inherits, "
        f"above < {r} AND n{r} IS NULL AS kept FROM records"
        for r in range(5)
    )
    return f"""{sql_facts(tree)},
tips AS (
  SELECT n.node, n.genome, m."Completeness" - 5 * m."Contamination" AS quality,
         row_number() OVER (ORDER BY m."Completeness" - 5 * m."Contamination" DESC NULLS FIRST, n.genome DESC) - 1 AS ord
  FROM nodes n JOIN metadata m ON n.genome = m."Name" WHERE n.magset <> 'GTDB'),
anchors AS (
  SELECT t.ord, min(p.distance) AS distance, arg_min(p.ancestor, p.distance) AS anchor
  FROM tips t JOIN path p ON t.node = p.node JOIN facts f ON f.node = p.ancestor WHERE f.gtdb GROUP BY t.ord),
met AS (
  SELECT t.ord, p.distance, b.* FROM tips t JOIN path p ON t.node = p.node JOIN bearing b ON b.node = p.ancestor
  LEFT JOIN anchors a ON a.ord = t.ord WHERE a.ord IS NULL OR p.distance < a.distance),
outright AS (SELECT node, min(ord) AS winner FROM met WHERE NOT deferred GROUP BY node),
named AS (
  SELECT node, winner FROM outright
  UNION ALL
  SELECT c.node, min(w.winner) FROM outright w JOIN path p ON p.node = w.node
  JOIN bearing c ON c.node = p.ancestor WHERE c.deferred GROUP BY c.node),
stops AS (
  SELECT m.ord, min(m.distance) AS distance, arg_min(n.winner, m.distance) AS source
  FROM met m JOIN named n ON m.node = n.node WHERE n.winner < m.ord GROUP BY m.ord),
borne AS (
  SELECT m.ord, m.distance, m.first, m.last, n.winner FROM met m JOIN named n ON m.node = n.node
  LEFT JOIN stops s ON s.ord = m.ord
  WHERE m.distance = s.distance OR (n.winner = m.ord AND (s.ord IS NULL OR m.distance < s.distance))),
local AS (SELECT ord, min(first) AS highest, {at_rank} FROM borne GROUP BY ord),
anchor_ranks AS (
  SELECT a.ord, a.anchor, CASE WHEN f.closer THEN f.rank - 1 ELSE f.rank END AS a
  FROM anchors a JOIN facts f ON a.anchor = f.node),
records AS (
  SELECT t.ord, t.genome, s.source, CASE WHEN s.ord IS NOT NULL THEN l.highest ELSE -1 END AS inherits,
         CASE WHEN s.ord IS NULL AND r.a >= 0 THEN r.a END AS a,
         CASE WHEN s.ord IS NULL AND r.a >= 0 THEN r.anchor END AS anchor,
         CASE WHEN s.ord IS NULL AND r.a >= 0 THEN r.a ELSE coalesce(l.highest, -1) END AS above,
         s.ord IS NOT NULL OR coalesce(r.a, -1) >= 0 OR coalesce(l.highest, 0) = 0 AS settled,
         l.n0, l.n1, l.n2, l.n3, l.n4
  FROM tips t LEFT JOIN stops s ON s.ord = t.ord LEFT JOIN local l ON l.ord = t.ord
  LEFT JOIN anchor_ranks r ON r.ord = t.ord),
own AS ({own}),
chase AS (
  SELECT ord, rank, ord AS at FROM own
  UNION ALL
  SELECT c.ord, c.rank, r.source FROM chase c JOIN records r ON r.ord = c.at WHERE c.rank <= r.inherits),
lineages AS (
  SELECT c.ord, c.rank, g.genome AS name, c.at FROM chase c JOIN own o ON o.ord = c.at AND o.rank = c.rank
  LEFT JOIN records g ON g.ord = o.name WHERE c.rank > o.inherits),
roots AS (SELECT l.ord, r.a, r.anchor, r.settled FROM lineages l JOIN records r ON r.ord = l.at WHERE l.rank = 0),
final AS (
  SELECT r.ord, r.genome, coalesce(t.a, -1) AS a, t.anchor, r.settled AND t.settled AS settled,
         string_agg(CASE l.rank WHEN 0 THEN 'p__' WHEN 1 THEN 'c__' WHEN 2 THEN 'o__' WHEN 3 THEN 'f__' ELSE 'g__' END
                    || l.name, ';' ORDER BY l.rank) FILTER (l.rank > coalesce(t.a, -1)) AS names,
         max(l.name) FILTER (l.rank = 4 AND 4 > coalesce(t.a, -1)) AS genus
  FROM records r JOIN lineages l ON l.ord = r.ord JOIN roots t ON t.ord = r.ord
  GROUP BY r.ord, r.genome, t.a, t.anchor, r.settled, t.settled),
species AS (SELECT ord, genome, 's__' || genus || ' ' || genome AS clade FROM final WHERE settled AND genus IS NOT NULL),
genome_taxonomy AS (
  SELECT f.genome, concat_ws(';', CASE WHEN f.a >= 0 THEN CAST(f.anchor AS VARCHAR) ELSE '{domain}' END, f.names, s.clade)
         AS taxonomy
  FROM final f LEFT JOIN species s ON s.ord = f.ord WHERE f.settled),
node_names AS (
  SELECT n.node, {sql_pick("r.rank", LETTERS)} || g.genome AS clade, g.genome AS genome_rep
  FROM named n JOIN bearing b ON b.node = n.node JOIN final g ON g.ord = n.winner AND g.settled
  JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS rank) r ON r.rank BETWEEN b.first AND b.last
  UNION ALL
  SELECT NULL, {sql_pick("o.rank", LETTERS)} || f.genome, f.genome FROM own o JOIN final f ON f.ord = o.ord AND f.settled WHERE o.kept
  UNION ALL
  SELECT NULL, clade, genome FROM species)"""


def sql_filled(tree: str) -> str:
    """CTEs up to ``filled_taxonomy`` and ``filled_names``."""
    return f"""{sql_naming(tree)},
parts AS (
  SELECT genome, taxonomy, starts_with(taxonomy, 'd__') AS complete,
         TRY_CAST(split_part(taxonomy, ';', 1) AS BIGINT) AS node,
         CASE WHEN contains(taxonomy, ';') THEN substr(taxonomy, strpos(taxonomy, ';') + 1) ELSE '' END AS rest
  FROM genome_taxonomy),
wanted AS (SELECT DISTINCT node, substr(rest, 1, 3) AS until FROM parts WHERE NOT complete),
votes AS (
  SELECT w.node, w.until, regexp_extract(x.taxonomy, '(.*);' || w.until, 1) AS prefix, count(*) AS votes
  FROM wanted w JOIN path p ON p.ancestor = w.node JOIN nodes n ON n.node = p.node JOIN taxonomy x ON x.genome = n.genome
  GROUP BY ALL),
chosen AS (
  SELECT node, until, prefix FROM votes QUALIFY row_number() OVER (PARTITION BY node, until ORDER BY votes, prefix) = 1),
joined AS (
  SELECT p.*, c.prefix, CASE WHEN p.rest = '' AND NOT p.complete
           THEN 's__' || substr(c.prefix, strpos(c.prefix, 'g__') + 3) || ' ' || p.genome END AS species
  FROM parts p LEFT JOIN chosen c ON c.node = p.node AND c.until = substr(p.rest, 1, 3) AND NOT p.complete),
filled_taxonomy AS (
  SELECT genome, CASE WHEN complete THEN taxonomy ELSE prefix || ';' || coalesce(species, rest) END AS taxonomy FROM joined),
filled_names AS (SELECT * FROM node_names UNION ALL SELECT NULL, species, genome FROM joined WHERE species IS NOT NULL)"""
