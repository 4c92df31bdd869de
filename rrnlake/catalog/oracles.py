"""SQL twins of the registered queries, for the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SEQS = """seqs AS (
  SELECT doc_id, 'DOC' || doc_id AS seqid, lang, source,
         translate(regexp_replace(lower(text), '[^a-z]', '', 'g'),
                   'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq
  FROM documents)"""

FEATURES = """features AS (
  SELECT CASE WHEN (user_id // 3) % 2 = 0 THEN 'Complete' ELSE 'Incomplete' END AS genome_set,
         'GCF_' || lpad(CAST(user_id // 3 AS VARCHAR), 9, '0') || '__NZ_' || user_id AS seqid,
         CASE WHEN event_type = 'signup' THEN 'tRNA' ELSE 'rRNA' END AS type,
         CAST(date_diff('minute', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS BIGINT) AS start,
         CAST(date_diff('minute', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 + round(value) AS BIGINT) AS "end",
         CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END AS strand,
         'ID=rna-' || event_id || CASE WHEN event_type = 'error' THEN ';partial=true;product=' ELSE ';product=' END ||
         CASE event_type WHEN 'view' THEN '16S ribosomal RNA' WHEN 'purchase' THEN '23S ribosomal RNA'
              WHEN 'error' THEN '16S ribosomal RNA' ELSE '5S ribosomal RNA' END AS attributes
  FROM events)"""

CONTIGS = """contigs AS (
  SELECT genome_set, seqid, max("end") AS length FROM features
  GROUP BY genome_set, seqid
  HAVING CAST(regexp_extract(seqid, '__NZ_(.*)$', 1) AS BIGINT) % 25 <> 24)"""

ALL_CONTIGS = """contigs AS (
  SELECT genome_set, seqid, max("end") AS length FROM features GROUP BY genome_set, seqid)"""

GENES = """genes AS (
  SELECT genome_set, seqid, start, "end", strand,
         CASE WHEN product LIKE '%16S%' THEN '16S' ELSE '23S' END AS gene, attributes
  FROM (SELECT *, regexp_replace(attributes, '.*product=', '') AS product FROM features
        WHERE type = 'rRNA' AND attributes NOT LIKE '%partial=true%')
  WHERE product IN ('16S ribosomal RNA', '23S ribosomal RNA', '16S Ribosomal RNA', '23S Ribosomal RNA',
                    'ribosomal RNA-16S', 'ribosomal RNA-23S'))"""

PAIRS = """near AS (
  SELECT *,
    lead(gene) OVER w AS ngene, lead(strand) OVER w AS nstrand, lead(start) OVER w AS nstart, lead("end") OVER w AS nend,
    lag(gene) OVER w AS pgene, lag(strand) OVER w AS pstrand, lag(start) OVER w AS pstart, lag("end") OVER w AS pend
  FROM genes WINDOW w AS (PARTITION BY seqid ORDER BY start, "end", strand, attributes)),
pairs AS (
  SELECT genome_set, seqid, strand, start AS start_16s, "end" AS end_16s,
         CASE WHEN strand = '+' THEN nstart ELSE pstart END AS start_23s,
         CASE WHEN strand = '+' THEN nend ELSE pend END AS end_23s, attributes
  FROM near
  WHERE gene = '16S' AND ((strand = '+' AND ngene = '23S' AND nstrand = '+')
                       OR (strand = '-' AND pgene = '23S' AND pstrand = '-')))"""

NUMBERED = """numbered AS (
  SELECT genome_set, seqid, strand, start_16s, end_16s, start_23s, end_23s,
         CASE WHEN genome_set = 'Complete' THEN 'C_' ELSE 'U_' END ||
         lpad(CAST(row_number() OVER (PARTITION BY genome_set
              ORDER BY seqid, start_16s, end_16s, strand, attributes) AS VARCHAR), 8, '0') AS operon_id
  FROM pairs)"""

QC = """spans AS (
  SELECT n.*, c.length AS sequence_length,
         CASE WHEN strand = '+' THEN start_23s - end_16s ELSE start_16s - end_23s END AS its_length,
         least(start_16s, end_16s, start_23s, end_23s) AS operon_start,
         greatest(start_16s, end_16s, start_23s, end_23s) AS operon_end
  FROM numbered n LEFT JOIN contigs c USING (seqid)),
qc AS (
  SELECT *, CASE WHEN its_length > 1500 THEN 'Unlinked' ELSE 'Linked' END AS linkage,
         (operon_start = 1 OR operon_end >= sequence_length) AS cross_boundary
  FROM spans)"""

MASTER = """master AS (
  SELECT genome_set, seqid, operon_id, 'Dummy' AS source, 'rRNA' AS type,
         CASE WHEN strand = '+' THEN end_16s ELSE end_23s END AS start_its,
         CASE WHEN strand = '+' THEN start_23s ELSE start_16s END AS end_its,
         start_16s, end_16s, start_23s, end_23s, CAST(NULL AS VARCHAR) AS score, strand,
         CAST(NULL AS VARCHAR) AS phase
  FROM qc WHERE NOT cross_boundary AND linkage = 'Linked')"""

OPERONS = (FEATURES, CONTIGS, GENES, PAIRS, NUMBERED, QC)

LINEAGE = """lineage AS (
  SELECT 'GCF_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS assembly,
         'd__' || r_name || '|p__' || n_name || '|c__' || c_mktsegment || '|o__O' || (c_custkey % 7) ||
         '|f__F' || (c_custkey % 5) || '|g__G' || (c_custkey % 3) || '|s__S' || c_custkey AS lineage
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LINEAGE8 = """lineage8 AS (
  SELECT assembly, 'k__' || lineage[4:] || '|t__' || assembly[5:] AS lineage FROM lineage)"""

ASSEMBLIES = """assemblies AS (
  SELECT 'GCF_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.' || (1 + o_orderkey % 12) AS accession,
         CASE WHEN o_custkey < 10 THEN 900000 ELSE 10000 END + o_custkey AS taxid,
         CASE WHEN o_orderstatus <> 'F' THEN 'latest' ELSE 'replaced' END AS version_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Complete Genome' WHEN '2-HIGH' THEN 'Chromosome'
              WHEN '3-MEDIUM' THEN 'Scaffold' ELSE 'Contig' END AS assembly_level,
         CASE WHEN o_orderkey % 13 <> 0 THEN 'https://ftp.example/genomes/all/GCF/000/000/001/GCF_' ||
              lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.' || (1 + o_orderkey % 12) || '_ASM' || o_orderkey
         END AS ftp_path, o_orderkey
  FROM orders)"""

SPLIT = """split AS (
  SELECT *, CASE WHEN assembly_level = 'Complete Genome' THEN 'Complete' ELSE 'Incomplete' END AS genome_set
  FROM assemblies WHERE version_status = 'latest')"""

ROWS = """rows AS (
  SELECT l_orderkey * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS cluster_id,
         CASE WHEN l_linestatus = 'F' THEN 'C_' ELSE 'U_' END || concat_ws('.', l_orderkey, l_partkey, l_suppkey,
           l_linenumber, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_quantity) AS BIGINT),
           date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)),
           CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT)) AS operon_id,
         'GCF_' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS assembly
  FROM lineitem)"""

MEMBERS = """members AS (
  SELECT cluster_id, operon_id, operon_id = min(operon_id) OVER (PARTITION BY cluster_id) AS is_centroid, assembly
  FROM rows)"""

SPECIES = """species AS (
  SELECT 'GCF_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS assembly,
         CASE WHEN s_nationkey < 20 THEN 'd__Bacteria' ELSE 'd__Archaea' END AS r1,
         'p__' || (s_nationkey % 5) AS r2, 'c__' || s_nationkey AS r3, 'o__' || s_nationkey AS r4,
         'f__' || s_nationkey AS r5, 'g__' || s_nationkey AS r6,
         CASE WHEN s_suppkey % 10 <> 9 THEN 's__' || s_suppkey END AS r7
  FROM supplier),
member_lineage AS (
  SELECT *, concat_ws('|', r1, r2, r3, r4, r5, r6, r7) AS lineage,
         concat_ws('|', r1, r2, r3, r4, r5, r6, coalesce(r7, 'NA')) AS united FROM species),
member_tax AS (SELECT m.*, s.* EXCLUDE (assembly) FROM members m LEFT JOIN member_lineage s USING (assembly))"""


def _same(i: int) -> str:
    return f"count(DISTINCT coalesce(r{i}, '<NA>')) = 1"


LCA = ("lca_level AS (SELECT cluster_id, CASE "
       + " ".join(f"WHEN {_same(i)} THEN {i}" for i in range(7, 0, -1))
       + " ELSE 0 END AS level FROM member_tax GROUP BY cluster_id),\n"
       "lca AS (SELECT d.cluster_id, c.operon_id, "
       "CASE level WHEN 7 THEN 'Species' WHEN 6 THEN 'Genus' WHEN 5 THEN 'Family' WHEN 4 THEN 'Order' "
       "WHEN 3 THEN 'Class' WHEN 2 THEN 'Phylum' WHEN 1 THEN 'Kingdom' ELSE 'Unknown' END AS lca_rank, lineage "
       "FROM (SELECT DISTINCT cluster_id, level, concat_ws('|', "
       + ", ".join(f"CASE WHEN level >= {i} THEN coalesce(r{i}, 'NA') ELSE 'NA' END" for i in range(1, 8))
       + ") AS lineage FROM member_tax JOIN lca_level USING (cluster_id)) d "
       "JOIN (SELECT cluster_id, operon_id FROM members WHERE is_centroid) c USING (cluster_id))")

MAJ = ("maj_counts AS ("
       + " UNION ALL ".join(
           f"SELECT cluster_id, {i} AS level, r{i} AS value, count(*) AS n FROM member_tax GROUP BY cluster_id, r{i}"
           for i in range(1, 8))
       + "),\nmaj_top AS (SELECT cluster_id, level FROM (SELECT *, rank() OVER (PARTITION BY cluster_id, level "
       "ORDER BY n DESC) AS place FROM maj_counts) WHERE place = 1 GROUP BY cluster_id, level HAVING count(*) = 1),\n"
       "maj_level AS (SELECT cluster_id, coalesce(max(t.level), 0) AS level FROM (SELECT DISTINCT cluster_id FROM members) "
       "LEFT JOIN maj_top t USING (cluster_id) GROUP BY cluster_id),\n"
       "maj AS (SELECT m.cluster_id, m.operon_id, CASE l.level WHEN 7 THEN united "
       + " ".join(f"WHEN {i} THEN regexp_replace(united, '\\|{'dpcofgs'[i]}__.*', '')" for i in range(6, 1, -1))
       + " ELSE regexp_replace(united, '\\|p__.*', '') END AS lineage "
       "FROM member_tax m JOIN maj_level l USING (cluster_id) WHERE is_centroid)")

TREE = """tree AS (
  SELECT CAST(1 AS BIGINT) AS tax_id, CAST(1 AS BIGINT) AS parent_id, 'no rank' AS rank, 'root' AS name
  UNION ALL SELECT 10 + r_regionkey, 1, 'domain', r_name FROM region
  UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name FROM nation
  UNION ALL SELECT 10000 + c_custkey, 100 + c_nationkey, 'species', c_name FROM customer),
walk AS (
  SELECT tax_id AS leaf, parent_id AS up, name AS path FROM tree WHERE tax_id <> parent_id
  UNION ALL
  SELECT w.leaf, t.parent_id, t.name || ';' || w.path FROM walk w JOIN tree t ON w.up = t.tax_id
  WHERE t.tax_id <> t.parent_id),
resolved AS (
  SELECT a.accession, a.taxid, CASE WHEN a.taxid >= 900000 THEN a.taxid - 890000 ELSE a.taxid END AS current_taxid,
         w.path AS lineage
  FROM assemblies a
  LEFT JOIN walk w ON w.up = 1 AND w.leaf = CASE WHEN a.taxid >= 900000 THEN a.taxid - 890000 ELSE a.taxid END)"""

TAXON_KEYS = """lifted AS (
  SELECT {value} AS value, is_complete, string_split({lineage}, '|') AS parts
  FROM genomes g LEFT JOIN {table} l USING (assembly)),
taxa AS (
  SELECT value, is_complete, parts[i] AS taxon, upper(regexp_replace(parts[i], '__.*', '')) AS rank,
         array_to_string(parts[1:i], '|') AS lineage
  FROM lifted, unnest(range(1, 8)) AS t(i) WHERE parts IS NOT NULL
  UNION ALL SELECT value, is_complete, NULL, NULL, NULL FROM lifted WHERE parts IS NULL)"""


def _taxon_stats(label: str) -> str:
    return f"""SELECT taxon, rank, lineage,
  count(*) AS genome_count_all, round(avg(value), 6) AS {label}_mean_all, median(value) AS {label}_median_all,
  nullif(count(*) FILTER (WHERE is_complete), 0) AS genome_count_complete,
  round(avg(value) FILTER (WHERE is_complete), 6) AS {label}_mean_complete,
  median(value) FILTER (WHERE is_complete) AS {label}_median_complete
FROM taxa GROUP BY taxon, rank, lineage"""


GENOME_LENGTH = """genomes AS (
  SELECT split_part(seqid, '__', 1) AS assembly, CAST(sum(length) AS BIGINT) AS genome_length,
         bool_or(genome_set = 'Complete') AS is_complete
  FROM contigs GROUP BY 1)"""
COPY_NUMBER = """genomes AS (
  SELECT split_part(seqid, '__', 1) AS assembly, count(*) AS copy_number,
         bool_or(genome_set = 'Complete') AS is_complete
  FROM master GROUP BY 1)"""

ORACLES["fasta_scan"] = _with(SEQS) + """SELECT seqid, lang || ' > ' || source AS description,
  CAST(length(seq) AS BIGINT) AS length, md5(seq) AS digest FROM seqs"""
ORACLES["gff_scan"] = _with(FEATURES) + """SELECT seqid, start, "end", CAST(NULL AS VARCHAR) AS score, strand,
  CAST(NULL AS VARCHAR) AS phase, attributes FROM features WHERE type = 'rRNA'"""
ORACLES["assembly_scan"] = _with(ASSEMBLIES) + """SELECT accession, taxid, version_status, assembly_level, ftp_path
FROM assemblies"""
ORACLES["lineage_scan"] = _with(LINEAGE) + "SELECT assembly, lineage FROM lineage"
ORACLES["cluster_records"] = _with(ROWS, MEMBERS) + """SELECT CASE WHEN is_centroid THEN 'S' ELSE 'H' END AS rec_type,
  cluster_id, CAST(NULL AS BIGINT) AS size, operon_id AS query FROM members
UNION ALL SELECT 'C', cluster_id, count(*), min(operon_id) FROM members GROUP BY cluster_id"""

ORACLES["assembly_split"] = _with(ASSEMBLIES, SPLIT) + "SELECT accession, taxid, assembly_level, genome_set FROM split"
ORACLES["assembly_lookup"] = _with(ASSEMBLIES, """twice AS (
  SELECT accession, taxid, version_status, assembly_level, ftp_path FROM assemblies
  UNION ALL SELECT accession, taxid, 'suppressed', assembly_level, ftp_path FROM assemblies WHERE o_orderkey % 10 = 0)""",
  """wanted AS (SELECT DISTINCT 'GCF_' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '.' ||
    CASE WHEN l_orderkey % 17 = 0 THEN 99 ELSE l_orderkey % 12 + 1 END AS accession
  FROM lineitem WHERE l_returnflag <> 'N')""") + """SELECT accession, taxid, version_status, assembly_level, ftp_path
FROM (SELECT w.accession, t.* EXCLUDE (accession), row_number() OVER (PARTITION BY w.accession
        ORDER BY taxid, version_status, assembly_level, ftp_path NULLS FIRST) AS place
      FROM wanted w LEFT JOIN twice t USING (accession))
WHERE place = 1 AND ftp_path IS NOT NULL"""
ORACLES["download_manifest"] = _with(ASSEMBLIES, SPLIT) + """SELECT accession, genome_set, kind,
  ftp_path || '/' || split_part(ftp_path, '/', 10) || '_genomic.' || suffix AS url,
  folder || genome_set || '/' || regexp_replace(accession, '\\.[0-9]+$', '') || '.' || suffix AS target
FROM split, (VALUES ('genome', 'fna.gz', 'Genomes_'), ('annotation', 'gff.gz', 'Annotation_')) k(kind, suffix, folder)
WHERE ftp_path IS NOT NULL"""
ORACLES["missing_annotation"] = _with(ASSEMBLIES) + """SELECT accession FROM assemblies
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
ORACLES["header_rewrite"] = _with(ASSEMBLIES) + """SELECT regexp_replace(accession, '\\.[0-9]+$', '') AS accession,
  regexp_replace(accession, '\\.[0-9]+$', '') || '__NZ_' || o_orderkey AS seqid,
  'C_' || o_orderkey AS consensus_id FROM assemblies"""
ORACLES["lineage_ranks"] = _with(LINEAGE, LINEAGE8) + "SELECT assembly, lineage, " + ", ".join(
    f"split_part(lineage, '|', {i + 1}) AS {r}"
    for i, r in enumerate(["kingdom", "phylum", "class", '"order"', "family", "genus", "species", "strain"])
) + " FROM lineage8"

ORACLES["rrna_genes"] = _with(FEATURES, GENES) + "SELECT * FROM genes"
ORACLES["operon_pairs"] = _with(FEATURES, GENES, PAIRS) + "SELECT * EXCLUDE (attributes) FROM pairs"
ORACLES["operon_ids"] = _with(FEATURES, GENES, PAIRS, NUMBERED) + (
    "SELECT operon_id, seqid, start_16s, start_23s FROM numbered")
ORACLES["operon_wide"] = _with(FEATURES, GENES, PAIRS, NUMBERED) + "SELECT * EXCLUDE (genome_set) FROM numbered"
ORACLES["operon_qc"] = _with(*OPERONS) + "SELECT * FROM qc"
ORACLES["rejected_operons"] = _with(*OPERONS) + "SELECT * FROM qc WHERE cross_boundary OR linkage = 'Unlinked'"
ORACLES["master_operons"] = _with(*OPERONS, MASTER) + "SELECT * FROM master"
ORACLES["its_regions"] = _with(*OPERONS, MASTER) + """SELECT seqid || ' ' || operon_id AS seqid_operon, source, type,
  start_its AS start, end_its AS "end", score, strand, phase FROM master"""
ORACLES["operon_regions"] = _with(*OPERONS, MASTER) + """SELECT seqid, source, type,
  least(start_16s, end_16s, start_23s, end_23s) AS start, greatest(start_16s, end_16s, start_23s, end_23s) AS "end",
  score, strand, phase FROM master"""
ORACLES["operon_identifiers"] = _with(*OPERONS, MASTER) + "SELECT seqid || ' ' || operon_id AS seqid_operon FROM master"

ORACLES["contig_lengths"] = _with(SEQS) + "SELECT seqid, CAST(length(seq) AS BIGINT) AS length FROM seqs"
ORACLES["extract_operons"] = _with(SEQS) + """SELECT 'C_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS operon_id,
  CASE WHEN doc_id % 2 = 0 THEN reverse(translate(piece, 'ACGT', 'TGCA')) ELSE piece END AS seq
FROM (SELECT doc_id, substring(seq, doc_id % 50 + 1, 200) AS piece FROM seqs WHERE length(seq) >= doc_id % 50 + 1)"""
ORACLES["length_sort"] = _with(SEQS) + """SELECT seqid, CAST(length(seq) AS BIGINT) AS length,
  row_number() OVER (ORDER BY length(seq) DESC, seqid) AS place FROM seqs"""
ORACLES["exact_dedupe"] = _with(SEQS) + """SELECT seqid, copies FROM (
  SELECT seqid, count(*) OVER (PARTITION BY seq) AS copies,
         row_number() OVER (PARTITION BY seq ORDER BY doc_id % 2, seqid) AS place FROM seqs) WHERE place = 1"""

ORACLES["split_id"] = _with(FEATURES, ALL_CONTIGS) + """SELECT seqid, split_part(seqid, '__', 1) AS assembly,
  split_part(seqid, '__', 2) AS contig FROM contigs"""
for _name, _table in (("rank_explode", "lineage"), ("rank_explode_strain", "lineage8")):
    ORACLES[_name] = _with(LINEAGE, LINEAGE8) + f"""SELECT assembly, parts[i] AS taxon,
  upper(parts[i][1:1]) AS rank, CAST(i AS INTEGER) AS rank_ord, array_to_string(parts[1:i], '|') AS lineage
FROM (SELECT assembly, string_split(lineage, '|') AS parts FROM {_table}), unnest(range(1, 8)) AS t(i)"""
ORACLES["genome_length"] = _with(FEATURES, ALL_CONTIGS, GENOME_LENGTH) + "SELECT * FROM genomes"
ORACLES["genome_length_stats"] = _with(
    FEATURES, ALL_CONTIGS, GENOME_LENGTH, LINEAGE,
    TAXON_KEYS.format(value="genome_length", lineage="lineage", table="lineage"),
) + _taxon_stats("genome_length")
ORACLES["copy_number"] = _with(*OPERONS, MASTER, COPY_NUMBER) + "SELECT * FROM genomes"
ORACLES["copy_number_stats"] = _with(
    *OPERONS, MASTER, COPY_NUMBER, LINEAGE,
    TAXON_KEYS.format(value="copy_number", lineage="lineage", table="lineage"),
) + _taxon_stats("copy_number")
ORACLES["copy_number_stats_strain"] = _with(
    *OPERONS, MASTER, COPY_NUMBER, LINEAGE, LINEAGE8,
    TAXON_KEYS.format(value="copy_number", lineage="regexp_replace(lineage, '\\|t__.*', '')", table="lineage8"),
) + _taxon_stats("copy_number")

ORACLES["cluster_members"] = _with(ROWS, MEMBERS) + "SELECT * FROM members"
ORACLES["cluster_sizes"] = _with(ROWS) + "SELECT cluster_id, count(*) AS size FROM rows GROUP BY cluster_id"
ORACLES["tax_full"] = _with(ROWS, MEMBERS, SPECIES) + "SELECT operon_id, lineage FROM member_tax"
ORACLES["tax_rep"] = _with(ROWS, MEMBERS, SPECIES) + """SELECT cluster_id, operon_id, 'k__' || lineage[4:] AS lineage
FROM member_tax WHERE is_centroid"""
ORACLES["tax_lca"] = _with(ROWS, MEMBERS, SPECIES, LCA) + "SELECT * FROM lca"
ORACLES["tax_lca_known"] = _with(ROWS, MEMBERS, SPECIES, LCA) + "SELECT * FROM lca WHERE lca_rank <> 'Unknown'"
ORACLES["lca_rank_summary"] = _with(ROWS, MEMBERS, SPECIES, LCA) + """SELECT lca_rank, n,
  round(100 * n / sum(n) OVER (), 6) AS percentage
FROM (SELECT lca_rank, count(*) AS n FROM lca GROUP BY lca_rank)"""
ORACLES["conflicting_species"] = _with(ROWS, MEMBERS, SPECIES, LCA) + """SELECT cluster_id, r7 AS species,
  count(*) AS operon_count FROM member_tax
WHERE cluster_id IN (SELECT cluster_id FROM lca_level WHERE level < 7) GROUP BY cluster_id, r7"""
ORACLES["tax_maj"] = _with(ROWS, MEMBERS, SPECIES, MAJ) + "SELECT * FROM maj"
ORACLES["maj_rank_summary"] = _with(ROWS, MEMBERS, SPECIES, MAJ) + """SELECT maj_rank, n,
  round(100 * n / sum(n) OVER (), 6) AS percentage
FROM (SELECT maj_rank, count(cluster_id) AS n
      FROM (VALUES (1, 'Kingdom'), (2, 'Phylum'), (3, 'Class'), (4, 'Order'), (5, 'Family'), (6, 'Genus'),
                   (7, 'Species')) r(level, maj_rank) LEFT JOIN maj_level USING (level) GROUP BY maj_rank)"""
_COMBINED = """combined AS (
  SELECT m.cluster_id, m.operon_id, m.lineage AS tax_rep, l.lca_rank, l.lineage AS tax_lca, j.lineage AS tax_maj
  FROM member_tax m LEFT JOIN lca l USING (cluster_id) LEFT JOIN maj j USING (cluster_id) WHERE m.is_centroid)"""
ORACLES["tax_combined"] = _with(ROWS, MEMBERS, SPECIES, LCA, MAJ, _COMBINED) + "SELECT * FROM combined"
ORACLES["complete_subset"] = _with(ROWS, MEMBERS, SPECIES, LCA, MAJ, _COMBINED) + (
    "SELECT * FROM combined WHERE operon_id LIKE 'C\\_%' ESCAPE '\\'")
ORACLES["lineage_resolve"] = "WITH RECURSIVE " + ASSEMBLIES + ",\n" + TREE + "\nSELECT * FROM resolved"
ORACLES["lineage_format"] = "WITH RECURSIVE " + ASSEMBLIES + ",\n" + TREE + """
SELECT accession, 'k__' || split_part(lineage, ';', 1) || '|p__' || split_part(lineage, ';', 2) ||
  '|c__|o__|f__|g__|s__' || split_part(lineage, ';', 3) || '|t__' AS lineage FROM resolved"""
ORACLES["export_union"] = _with(*OPERONS) + """SELECT operon_id, seqid, operon_start, operon_end, linkage,
  'GTDB' AS taxonomy_system, genome_set, CAST(NULL AS BOOLEAN) AS cross_boundary
FROM qc WHERE NOT cross_boundary AND linkage = 'Linked'
UNION ALL SELECT operon_id, seqid, operon_start, operon_end, linkage, 'NCBI', genome_set, cross_boundary
FROM qc WHERE cross_boundary OR linkage = 'Unlinked'"""


def _rc(primer: str) -> str:
    return primer[::-1].translate(str.maketrans("ACGTRYN", "TGCAYRN"))


def _re(primer: str) -> str:
    return primer.replace("R", "[AG]").replace("Y", "[CT]").replace("N", "[ACGT]")


def _wrong(primer: str) -> str:
    """Positions of w that a primer does not allow."""
    one = {"R": "AG", "Y": "CT", "N": "ACGT"}
    return " + ".join(f"CASE WHEN w[{i}:{i}] IN ({', '.join(repr(c) for c in one.get(x, x))}) THEN 0 ELSE 1 END"
                      for i, x in enumerate(primer, 1))


def _sites(identity: float = 1.0) -> str:
    """Primer places per pair, strand and side, and per left place the later right one with the fewest mismatches."""
    parts = []
    for pair, fwd, rev in (("P1", "ACGTR", "YACG"), ("P2", "GGNA", "TTRC")):
        for strand, left, right in (("+", fwd, _rc(rev)), ("-", rev, _rc(fwd))):
            for side, p in (("L", left), ("R", right)):
                allowed = int((1 - identity) * len(p) + 1e-9)
                parts.append(
                    f"SELECT seqid, '{pair}' AS pair, '{strand}' AS strand, '{side}' AS side, i AS pos, "
                    f"{len(left)} AS llen, {len(right)} AS rlen, {_wrong(p)} AS wrong FROM words "
                    f"WHERE length(w) >= {len(p)} AND {_wrong(p)} <= {allowed}")
    best = ("min(CASE WHEN side = 'R' THEN wrong * 1000000000 + pos END) OVER (PARTITION BY seqid, pair, strand ORDER BY pos "
            "RANGE BETWEEN {} FOLLOWING AND UNBOUNDED FOLLOWING)")
    return ("words AS (SELECT seqid, i, substring(seq, i, 5) AS w FROM seqs, unnest(range(1, length(seq) + 1)) t(i)),\n"
            "sites AS (" + "\nUNION ALL ".join(parts) + "),\n"
            f"near AS (SELECT *, CASE WHEN llen = 4 THEN {best.format(4)} ELSE {best.format(5)} END AS stop FROM sites),\n"
            "hits AS (SELECT seqid, pair, strand, CAST(pos AS INTEGER) AS start, llen, rlen, "
            "CAST(stop % 1000000000 + rlen - 1 AS INTEGER) AS \"end\", "
            "CAST(wrong + stop // 1000000000 AS INTEGER) AS mismatches FROM near WHERE side = 'L' AND stop IS NOT NULL)")


def _strand_cut(start: str, end: str) -> str:
    piece = f"substring(seq, {start}, {end} - ({start}) + 1)"
    return f"CASE WHEN strand = '-' THEN reverse(translate({piece}, 'ACGT', 'TGCA')) ELSE {piece} END"


_LONG = " UNION ALL ".join(
    f"SELECT seqid, '{pair}' AS pair, '{strand}' AS strand, '{side}' AS side, i AS pos FROM long_words WHERE regexp_full_match(w, '{_re(p)}')"
    for pair, fwd, rev in (("L1", "CACNCGYA", "TAGGNTAR"), ("L2", "CACCACTA", "AGTGYATT"))
    for strand, left, right in (("+", fwd, _rc(rev)), ("-", rev, _rc(fwd))) for side, p in (("L", left), ("R", right)))
ORACLES["insilico_pcr"] = _with(
    SEQS, "long_words AS (SELECT seqid, i, substring(seq, i, 8) AS w FROM seqs, unnest(range(1, length(seq) - 6)) t(i))",
    f"long_sites AS ({_LONG})", """products AS (
  SELECT l.seqid, l.pair, l.strand, CAST(l.pos AS INTEGER) AS start, CAST(r.pos + 7 AS INTEGER) AS "end"
  FROM long_sites l JOIN long_sites r ON l.seqid = r.seqid AND l.pair = r.pair AND l.strand = r.strand
  WHERE l.side = 'L' AND r.side = 'R' AND r.pos >= l.pos + 8 AND r.pos + 8 - l.pos <= 10000)""") + f"""SELECT
  seqid, pair, strand, start, "end", "end" - start + 1 AS length, {_strand_cut('start', '"end"')} AS amplicon
FROM products JOIN seqs USING (seqid)"""
ORACLES["primer_yield"] = _with(SEQS, _sites()) + """SELECT pair, (SELECT count(*) FROM seqs) AS sequences,
  count(DISTINCT seqid) AS amplified, round(100 * count(DISTINCT seqid) / (SELECT count(*) FROM seqs), 6) AS percentage
FROM hits WHERE "end" - start + 1 <= 10000 GROUP BY pair"""
for _name, _identity in (("extract_reads", 1.0), ("extract_reads_tolerant", 0.8)):
    ORACLES[_name] = _with(SEQS, _sites(_identity), """best AS (
  SELECT seqid, pair, strand, mismatches, start + llen AS s, "end" - rlen AS e FROM hits
  QUALIFY row_number() OVER (PARTITION BY seqid, pair ORDER BY mismatches, strand, start + llen, "end" - rlen) = 1)""") + f"""SELECT
  seqid, pair, strand, mismatches, {_strand_cut('s', 'e')} AS read
FROM best JOIN seqs USING (seqid) WHERE e - s + 1 >= 100"""

_WORDS7 = """words AS (
  SELECT seqid, lang, substring(seq, i, 7) AS kmer FROM seqs, unnest(range(1, length(seq) - 5)) t(i))"""
ORACLES["kmer_counts"] = _with(SEQS, _WORDS7) + "SELECT lang, kmer, count(*) AS n FROM words GROUP BY lang, kmer"
ORACLES["nb_classify"] = _with(SEQS, _WORDS7, """profile AS (SELECT lang, kmer, count(*) AS n FROM words GROUP BY lang, kmer)""",
  """totals AS (SELECT lang, ln(0.001 / (sum(n) + 0.001 * (SELECT count(DISTINCT kmer) FROM words))) AS base
  FROM profile GROUP BY lang)""",
  """docs AS (SELECT seqid, kmer, count(*) AS n FROM words GROUP BY seqid, kmer)""",
  """gains AS (SELECT seqid, lang, sum(d.n * ln((p.n + 0.001) / 0.001)) AS gain FROM docs d JOIN profile p USING (kmer)
  GROUP BY seqid, lang)""",
  """scores AS (SELECT s.seqid, t.lang, s.total * t.base + coalesce(g.gain, 0) AS score
  FROM (SELECT seqid, sum(n) AS total FROM docs GROUP BY seqid) s CROSS JOIN totals t
  LEFT JOIN gains g ON g.seqid = s.seqid AND g.lang = t.lang)""") + """SELECT seqid, label, score
FROM seqs LEFT JOIN (SELECT seqid, lang AS label, round(score, 3) AS score
  FROM scores QUALIFY row_number() OVER (PARTITION BY seqid ORDER BY score DESC, lang DESC) = 1) USING (seqid)"""
ORACLES["ani_pairs"] = _with(SEQS, """hashed AS (
  SELECT genome, list_sort(list_distinct(list(left(md5(least(w, reverse(translate(w, 'ACGT', 'TGCA')))), 16))))[1:1000] AS hs
  FROM (SELECT source || '_' || (doc_id // 200) AS genome, substring(seq, i, 16) AS w
        FROM seqs, unnest(range(1, length(seq) - 14)) t(i)) GROUP BY genome)""",
  """paired AS (SELECT a.genome AS a, b.genome AS b, list_sort(list_distinct(list_concat(a.hs, b.hs)))[1:1000] AS u,
         list_intersect(a.hs, b.hs) AS i FROM hashed a JOIN hashed b ON a.genome < b.genome)""",
  """counted AS (SELECT a, b, CAST(len(list_intersect(i, u)) AS BIGINT) AS shared, len(u) AS n FROM paired)""",
  """est AS (SELECT a, b, shared, 100 * (1 + ln(2 * (shared / n) / (1 + shared / n)) / 16) AS est_ani
  FROM counted WHERE shared > 0)""") + "SELECT a, b, shared, round(est_ani, 6) AS est_ani FROM est WHERE est_ani >= 80 - 1e-9"

# Identity 1: a match is containment, and containment carries over, so a sequence is a centroid if no earlier one holds it.
_HOLDERS = """d AS (SELECT seq, min(seqid) AS seqid, length(seq) AS n FROM s GROUP BY seq),
p AS (SELECT *, row_number() OVER (ORDER BY n DESC, seqid) AS place FROM d),
h AS (SELECT a.place, a.n, o.place AS holder FROM p a JOIN p o ON o.place < a.place AND contains(o.seq, a.seq)),
c AS (SELECT * FROM p WHERE place NOT IN (SELECT place FROM h))"""

ORACLES["contained_clusters"] = _with(SEQS, "s AS (SELECT seqid, seq FROM seqs)", _HOLDERS) + """
SELECT s.seqid, c.seqid AS centroid, s.seqid = c.seqid AS is_centroid, 0 AS edits, 1.0::DOUBLE AS identity
FROM s JOIN p USING (seq)
JOIN (SELECT p.place, coalesce(min(h.holder), p.place) AS first FROM p LEFT JOIN h ON h.place = p.place AND h.holder IN (SELECT place FROM c)
      GROUP BY p.place) b ON b.place = p.place
JOIN c ON c.place = b.first"""

ORACLES["contained_pairs"] = _with(SEQS, """s AS (
  SELECT seqid, seq FROM seqs UNION ALL SELECT seqid || 'h', right(seq, length(seq) // 2) FROM seqs)""", _HOLDERS) + """
SELECT p.seqid, c.seqid AS centroid, 0 AS edits, 1.0::DOUBLE AS identity
FROM h JOIN p USING (place) JOIN c ON c.place = h.holder"""

ORACLES["contained_merge"] = _with(SEQS, "s AS (SELECT seqid, seq FROM seqs WHERE doc_id % 2 = 0)", _HOLDERS, """
every AS (
  SELECT seqid, seq, 0 AS priority FROM c UNION ALL SELECT seqid, seq, 1 FROM seqs WHERE doc_id % 2 = 1),
q AS (
  SELECT seq, min(priority) AS priority, min_by(seqid, (priority, seqid)) AS seqid, length(seq) AS n FROM every GROUP BY seq),
r AS (SELECT *, row_number() OVER (ORDER BY priority, n DESC, seqid) AS place FROM q),
o AS (
  SELECT a.place, e.place AS holder FROM r a JOIN r e ON a.priority = 1 AND e.priority = 0 AND (contains(e.seq, a.seq) OR contains(a.seq, e.seq))),
w AS (
  SELECT a.place, e.place AS holder FROM r a JOIN r e ON a.priority = 1 AND e.priority = 1 AND e.place < a.place AND contains(e.seq, a.seq)
  WHERE e.place NOT IN (SELECT place FROM o)),
k AS (SELECT * FROM r WHERE priority = 0 OR place NOT IN (SELECT place FROM o UNION ALL SELECT place FROM w)),
m AS (SELECT * FROM o UNION ALL SELECT * FROM w WHERE holder IN (SELECT place FROM k))""") + """
SELECT every.seqid, k.seqid AS centroid, every.seqid = k.seqid AS is_centroid
FROM every JOIN r USING (seq) JOIN (
  SELECT r.place, coalesce(min(m.holder), r.place) AS first FROM r LEFT JOIN m ON m.place = r.place GROUP BY r.place) b ON b.place = r.place
JOIN k ON k.place = b.first"""

ORACLES["cluster_consensus"] = _with(SEQS) + """
SELECT doc_id AS cluster_id, seqid || 'a' AS operon_id, length(out)::INT AS n, md5(out) AS seq_md5 FROM (
  SELECT doc_id, seqid, CASE WHEN length(seq) < 40 THEN seq ELSE substring(seq, 1, cut) || CASE doc_id % 3 WHEN 0 THEN translate(substring(seq, cut + 1, 1), 'ACGT', 'CGTA')
         WHEN 1 THEN '' ELSE substring(seq, cut + 1, 1) || translate(substring(seq, cut + 1, 1), 'ACGT', 'CGTA') END || substring(seq, cut + 2) END AS out
  FROM (SELECT *, 15 + (doc_id * 37) % greatest(length(seq) - 30, 1) AS cut FROM seqs))"""
