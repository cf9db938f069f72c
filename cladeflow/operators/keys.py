"""One BIGINT key for nodes of several domains, so that all domains go through one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.ranks import per_domain
from cladeflow.params import DomainParams


class NodeKeys:
    """Node ids are unique within a domain only; the key interleaves them by domain."""

    def __init__(self, domains: tuple[DomainParams, ...]):
        self.domains = domains
        self.bits = (len(domains) - 1).bit_length()

    def tagged(self, frame: DataFrame) -> DataFrame:
        """The frame with a ``domain`` column, which may be missing if there is one domain."""
        if "domain" in frame.columns:
            return frame
        if len(self.domains) > 1:
            raise ValueError("several domains need a domain column")
        return frame.withColumn("domain", F.lit(self.domains[0].domain))

    def key(self, node: Column, domain: Column) -> Column:
        index = per_domain(domain, {p.domain: F.lit(i) for i, p in enumerate(self.domains)})
        return F.shiftleft(node.cast("bigint"), self.bits) + index

    def node(self, key: Column) -> Column:
        return F.shiftright(key, self.bits)

    def domain(self, key: Column) -> Column:
        index = key.bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")
        return F.get(F.array(*[F.lit(p.domain) for p in self.domains]), index)

    def untagged(self, frame: DataFrame, like: DataFrame) -> DataFrame:
        """Drop the ``domain`` column again if the input had none."""
        return frame if "domain" in like.columns else frame.drop("domain")
