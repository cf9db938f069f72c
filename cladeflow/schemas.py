"""Column types of the tables, by name. Order in files does not matter."""

NODES = {
    "parent": "bigint",
    "node": "bigint",
    "branch_length": "double",
    "label": "string",
    "RED": "double",
    "bootstrap": "double",
    "taxa": "string",
    "genome": "string",
    "magset": "string",
    "nongtdb_group": "string",
    "novelty_red": "string",
}
INFO = {
    "ID": "string",
    "domain": "string",
    "checkm2_completeness": "double",
    "checkm2_contamination": "double",
}
METADATA = {"Name": "string", "Completeness": "double", "Contamination": "double"}
TAXONOMY = {"genome": "string", "taxonomy": "string"}
FASTA_PATHS = {"fasta": "string"}
NODE_NAMES = {"node": "bigint", "clade": "string", "genome_rep": "string"}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
