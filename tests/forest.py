"""Small trees for tests, many of them in one node table, and the naming rules by brute force over their paths."""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass, field

from cladeflow.params import RANKS, DomainParams

NODE_DDL = "parent bigint, node bigint, nongtdb_group string, genome string, magset string, RED double, novelty_red string"
METADATA_DDL = "Name string, Completeness double, Contamination double"


@dataclass
class Tree:
    """Inner nodes as ``{node: (parent, red)}``, tips as ``{genome: parent}``; a root is its own parent."""

    inner: dict[int, tuple[int, float]]
    tips: dict[str, int]
    quality: dict[str, float]
    lineages: dict[str, str] = field(default_factory=dict)  # reference tips

    def path(self, node: int) -> list[int]:
        steps = [node]
        while self.inner[steps[-1]][0] != steps[-1]:
            steps.append(self.inner[steps[-1]][0])
        return steps

    def reference_nodes(self) -> set[int]:
        return {node for genome in self.lineages for node in self.path(self.tips[genome])}

    def rows(self, params: DomainParams, offset: int = 0) -> list[tuple]:
        reference = self.reference_nodes()
        words = ("Phylum (a]", "Class (a]", "Order (a]", "Family (a]", "Genus (a]", "Species/Strain (a]")
        rows = [
            (
                parent + offset,
                node + offset,
                "gtdb" if node in reference else "nongtdb",
                None,
                None,
                red,
                words[rank_of(red, params)] if red > 0 else None,
            )
            for node, (parent, red) in self.inner.items()
        ]
        first_tip = max(self.inner) + 1
        for number, (genome, parent) in enumerate(self.tips.items()):
            group, source = ("gtdb", "GTDB") if genome in self.lineages else ("nongtdb", "other")
            rows.append((parent + offset, first_tip + number + offset, group, genome, source, 1.0, words[5]))
        return rows


def rank_of(red: float, params: DomainParams) -> int:
    return next(rank for rank, edge in enumerate(params.upper_edges) if red <= edge)


class Rules:
    """The naming rules, each stated for all nodes or genomes of a small tree at once; paths are simply listed.

    Valid where RED strictly increases between new nodes of one rank.
    """

    def __init__(self, tree: Tree, params: DomainParams):
        self.tree, self.params = tree, params
        self.known = tree.reference_nodes()
        self.rank = {n: rank_of(red, params) for n, (_, red) in tree.inner.items()}
        self.new = sorted((g for g in tree.tips if g not in tree.lineages and g in tree.quality), key=lambda g: (tree.quality[g], g), reverse=True)
        self.order = {g: k for k, g in enumerate(self.new)}
        self.way = {g: [n for n in tree.path(tree.tips[g]) if n not in self.known] for g in self.new}
        self.ranks, self.waits = {}, set()
        for node in tree.inner:
            if node not in self.known:
                self._bear(node)
        self.owner = {
            n: min((g for g in self.new if n in self.way[g]), key=self.order.get, default=None) for n in self.ranks if n not in self.waits
        }
        for node in self.waits:
            below = [self.owner[n] for n in self.owner if n not in self.waits and n != node and self.owner[n] and node in tree.path(n)]
            self.owner[node] = min(below, key=self.order.get, default=None)

    def parent(self, node: int) -> int:
        return self.tree.inner[node][0]

    def closer(self, node: int) -> bool:
        """Closer to the median of its rank than its parent is."""
        up = 0.0 if self.parent(node) == node else self.tree.inner[self.parent(node)][1]
        median = self.params.medians[self.rank[node]]
        return abs(self.tree.inner[node][1] - median) < abs(up - median)

    def equal(self, node: int) -> bool:
        return node not in self.known and self.rank[node] == self.rank[self.parent(node)]

    def skipped(self, node: int) -> bool:
        children = [n for n in self.tree.inner if self.parent(n) == node != n and n not in self.known]
        return self.equal(node) and self.closer(node) and bool(children)

    def _bear(self, node: int) -> None:
        up = self.parent(node)
        if node == up or self.skipped(node):
            return
        own = [self.rank[node]] if self.equal(node) else list(range(self.rank[up], self.rank[node]))
        if (self.equal(up) or up in self.known) and not self.closer(up):
            if len(own) == 2:
                self.waits.add(node)
            own = own[1:]
        own = [r for r in own if r < 5]
        if own:
            self.ranks[node] = own
        else:
            self.waits.discard(node)

    def stop(self, genome: str) -> int | None:
        named = (n for n in self.way[genome] if self.owner.get(n) and self.order[self.owner[n]] < self.order[genome])
        return next(named, None)

    def lineage(self, genome: str) -> tuple[int | None, int, dict[int, str]]:
        """Anchor node or None, its rank or -1, and the genomes that ranks below it are named after."""
        stop = self.stop(genome)
        names = {r: genome for n in self.way[genome] if self.owner.get(n) == genome for r in self.ranks[n]}
        if stop is not None:
            cut_at = self.way[genome].index(stop)
            names = {r: genome for n in self.way[genome][:cut_at] if self.owner.get(n) == genome for r in self.ranks[n]}
            names |= {r: self.owner[stop] for r in self.ranks[stop]}
            anchor, at, above = self.lineage(self.owner[stop])
            names |= {r: name for r, name in above.items() if r < min(names)}
        else:
            anchor = next((n for n in self.tree.path(self.tree.tips[genome]) if n in self.known), None)
            at = -1 if anchor is None else self.rank[anchor] - self.closer(anchor)
            if at < 0:
                anchor = None
        return anchor, at, {r: names.get(r, genome) for r in range(at + 1, 5)}

    def results(self) -> tuple[dict[str, str], list[tuple]]:
        """Taxonomy per new genome and all (node, clade, genome) rows."""
        taxonomy = {}
        rows = [(n, f"{RANKS[r][0]}__{g}", g) for n, g in self.owner.items() if g for r in self.ranks[n]]
        attached = {(clade, g) for _, clade, g in rows}
        for genome in self.new:
            anchor, at, names = self.lineage(genome)
            parts = [self.params.domain if anchor is None else str(anchor)]
            parts += [f"{RANKS[r][0]}__{name}" for r, name in names.items()]
            rows += [(None, c, genome) for r, name in names.items() if name == genome and ((c := f"{RANKS[r][0]}__{genome}"), genome) not in attached]
            if at < 4:
                parts.append(f"s__{names[4]} {genome}")
                rows.append((None, parts[-1], genome))
            taxonomy[genome] = ";".join(parts)
        return taxonomy, rows


def filled(tree: Tree, taxonomy: dict[str, str], offset: int = 0) -> tuple[dict[str, str], list[tuple]]:
    """Complete strings; all lineages of the trees have seven ranks."""
    full, added = {}, []
    for genome, text in taxonomy.items():
        start, *rest = text.split(";")
        if start.isdigit():
            below = [line.split(";") for tip, line in tree.lineages.items() if int(start) - offset in tree.path(tree.tips[tip])]
            keep = 7 - max(len(rest), 1)
            votes = Counter(";".join(line[:keep]) for line in below)
            rarest = min(votes.items(), key=lambda vote: (vote[1], vote[0]))[0]
            if not rest:
                rest = [f"s__{rarest.split(';')[-1][3:]} {genome}"]
                added.append((None, rest[0], genome))
            text = ";".join([rarest, *rest])
        full[genome] = text
    return full, added


def random_tree(rng: random.Random, label: str) -> Tree:
    """A random tree whose RED grows downwards."""
    inner = {0: (0, round(rng.uniform(0.02, 0.3), 2))}
    for node in range(1, rng.randint(3, 30)):
        parent = rng.choice([rng.randrange(node), node - 1])
        low = inner[parent][1]
        red = low + (1 - low) * rng.choice([0.02, 0.05, 0.1, 0.2, 0.4, 0.6]) * rng.uniform(0.5, 1)
        inner[node] = (parent, red)
    childless = set(inner) - {parent for node, (parent, _) in inner.items() if node != parent}
    spots = [node for node in childless for _ in range(rng.randint(1, 3))]
    spots += [rng.randrange(len(inner)) for _ in range(rng.randint(0, 12))]
    rng.shuffle(spots)
    tips = {f"{label}_{number}": spot for number, spot in enumerate(spots)}
    share = rng.choice([0, 0.1, 0.3])
    lineages = {}
    for genome in tips:
        if rng.random() < share:
            parts = [f"{rank[0]}__{rng.choice('XY')}{label}" for rank in RANKS]
            lineages[genome] = "d__Bacteria;" + ";".join(parts)
    quality = {genome: float(rng.randint(50, 60)) for genome in tips}
    return Tree(inner, tips, quality, lineages)
