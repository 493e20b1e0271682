"""Controlled vocabularies. All operators take vocabularies as arguments; these
are the usual ones for biology sources."""

from __future__ import annotations

# Species name -> NCBI taxonomy id.
SPECIES_TAXON = {
    "Homo sapiens": "9606",
    "Mus musculus": "10090",
    "Rattus norvegicus": "10116",
    "Bos taurus": "9913",
    "Gallus gallus": "9031",
    "Sus scrofa": "9823",
    "Canis familiaris": "9615",
    "Danio rerio": "7955",
    "Xenopus tropicalis": "8364",
    "Drosophila melanogaster": "7227",
    "Caenorhabditis elegans": "6239",
    "Dictyostelium discoideum": "44689",
    "Schizosaccharomyces pombe": "4896",
    "Saccharomyces cerevisiae": "4932",
    "Plasmodium falciparum": "5833",
    "Mycobacterium tuberculosis": "1773",
}

# Evidence code -> evidence ontology term.
EVIDENCE_TERM = {
    "TAS": "ECO:0000304",
    "IEA": "ECO:0000501",
}

# Gene panels by disease.
GENE_PANELS = {
    "als": ["SOD1", "C9orf72", "FUS", "TARDBP"],
    "alzheimers": ["APP", "PSEN1", "PSEN2", "APOE", "MAPT"],
}

# First fields (lower case) that mark a header line.
HEADER_WORDS = ("identifier", "stable_id", "uniprot", "source")

# Public namespaces. The model namespace and the node namespace
# belong to the caller; the two below are placeholders.
NAMESPACES = {
    "biolink": "https://w3id.org/biolink/vocab/",
    "infores": "https://w3id.org/biolink/infores/",
    "HGNC": "https://identifiers.org/hgnc:",
    "UNIPROT": "https://identifiers.org/uniprot:",
    "NCBITaxon": "http://purl.obolibrary.org/obo/NCBITaxon_",
    "GO": "http://purl.obolibrary.org/obo/GO_",
    "ECO": "http://purl.obolibrary.org/obo/ECO_",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "dcterms": "http://purl.org/dc/terms/",
    "prov": "http://www.w3.org/ns/prov#",
    "void": "http://rdfs.org/ns/void#",
    "pav": "http://purl.org/pav/",
    "model": "https://example.org/model#",
    "P": "https://example.org/pathway/",
}
