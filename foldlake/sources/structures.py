"""Structure files: mmCIF and PDB texts parsed to rows of atoms, entities, connections and resolutions.

Files are read with the binaryFile source and parsed in Arrow batches, a file at a time. A file that can't be parsed
gives one row with its error and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ATOM_SITE = (
    "structure_id string, model_num int, atom_serial int, group_pdb string, label_asym_id string, auth_asym_id string,"
    " label_comp_id string, label_seq_id string, auth_seq_id string, ins_code string, atom_name string, altloc string,"
    " occupancy double, b_factor double, element string, x double, y double, z double, error string"
)
ENTITY_POLY = "structure_id string, entity_id string, seq_raw string, strand_ids string, poly_type string"
STRUCT_CONN = (
    "structure_id string, conn_type_id string, ptnr1_label_asym_id string, ptnr1_label_seq_id string, ptnr1_label_comp_id string,"
    " ptnr2_label_asym_id string, ptnr2_label_seq_id string, ptnr2_label_comp_id string"
)
REFINE = "structure_id string, ls_d_res_high double"
PARSED = ATOM_SITE + ", resolution double"

_TOKEN = re.compile(r"""'(?:[^']|'(?=\S))*'(?=\s|$)|"(?:[^"]|"(?=\S))*"(?=\s|$)|\#[^\n]*|[^\s]+""")


def cif_tokens(text: str) -> Iterator[tuple[str, bool]]:
    """Tokens of an mmCIF text and whether they were quoted; comments are left out."""
    lines, at = text.split("\n"), 0
    while at < len(lines):
        line = lines[at]
        at += 1
        if line.startswith(";"):
            block = [line[1:]]
            while at < len(lines) and not lines[at].startswith(";"):
                block.append(lines[at])
                at += 1
            yield "\n".join(block), True
            if at < len(lines):
                lines[at] = lines[at][1:]
            continue
        for found in _TOKEN.finditer(line.rstrip("\r")):
            token = found[0]
            if token[0] == "#":
                continue
            if token[0] in "'\"" and len(token) > 1 and token[-1] == token[0]:
                yield token[1:-1], True
            else:
                yield token, False


def cif_tables(text: str) -> dict[str, list[dict[str, str | None]]]:
    """Rows of each category of the first data block; `?` and `.` are null."""
    tables: dict[str, list[dict[str, str | None]]] = {}
    names: list[str] = []
    values: list[str | None] = []
    state, tag, blocks = "", "", 0

    def close() -> None:
        if names and values:
            category = names[0].split(".")[0].lower()
            short = [n.partition(".")[2] for n in names]
            rows = tables.setdefault(category, [])
            rows += [dict(zip(short, values[i : i + len(short)])) for i in range(0, len(values) - len(short) + 1, len(short))]

    for token, quoted in cif_tokens(text):
        low = token.lower()
        if not quoted and low.startswith("data_"):
            blocks += 1
            if blocks > 1:
                break
        elif not quoted and low == "loop_":
            close()
            names, values, state = [], [], "names"
        elif not quoted and token.startswith("_"):
            if state == "names" and not values:
                names.append(token)
            else:
                if state in ("names", "values"):
                    close()
                    names, values = [], []
                state, tag = "tag", token
        else:
            value = None if not quoted and token in ("?", ".") else token
            if state in ("names", "values"):
                state = "values"
                values.append(value)
            elif state == "tag":
                category, _, short = tag.partition(".")
                rows = tables.setdefault(category.lower(), [{}])
                rows[0][short] = value
                state = ""
    close()
    return tables


def _number(text: str | None) -> float | None:
    try:
        return float(text) if text else None
    except ValueError:
        return None


def cif_atoms(structure: str, text: str) -> list[tuple]:
    return _cif_rows(structure, cif_tables(text))


def _cif_resolution(tables: dict[str, list[dict[str, str | None]]]) -> float | None:
    return _number((tables.get("_refine") or [{}])[0].get("ls_d_res_high"))


def _pdb_resolution(text: str) -> float | None:
    got = re.search(r"^REMARK   2 RESOLUTION\.\s+([0-9.]+)", text, re.M)
    return _number(got[1]) if got else None


def _cif_rows(structure: str, tables: dict[str, list[dict[str, str | None]]]) -> list[tuple]:
    out = []
    for at, r in enumerate(tables.get("_atom_site", ())):
        label, comp = r.get("label_asym_id"), r.get("label_comp_id")
        out.append(
            (structure, int(_number(r.get("pdbx_PDB_model_num")) or 1), at, r.get("group_PDB"), label, r.get("auth_asym_id") or label, comp)
            + (r.get("label_seq_id"), r.get("auth_seq_id") or r.get("label_seq_id"), r.get("pdbx_PDB_ins_code"))
            + (r.get("label_atom_id"), r.get("label_alt_id"), _number(r.get("occupancy")), _number(r.get("B_iso_or_equiv")))
            + (r.get("type_symbol"), _number(r.get("Cartn_x")), _number(r.get("Cartn_y")), _number(r.get("Cartn_z")), None)
        )
    return out


def pdb_atoms(structure: str, text: str) -> list[tuple]:
    out, model = [], 1
    for line in text.splitlines():
        if line.startswith("MODEL"):
            model = int(_number(line[10:14].strip()) or model)
        elif line.startswith(("ATOM  ", "HETATM")):
            chain, number = line[21:22].strip() or None, line[22:26].strip() or None
            out.append(
                (structure, model, len(out), line[:6].strip(), chain, chain, line[17:20].strip(), number, number, line[26:27].strip() or None)
                + (line[12:16].strip(), line[16:17].strip() or None, _number(line[54:60].strip()), _number(line[60:66].strip()))
                + (line[76:78].strip() or None, _number(line[30:38]), _number(line[38:46]), _number(line[46:54]), None)
            )
    return out


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and content of the files below a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "content")


def _keyed(found: DataFrame) -> DataFrame:
    """found with structure_id: its own, or the stem of the file's name. Files of one name in several folders need ids of
    their own (relative_id)."""
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"(?i)\.(cif|mmcif|pdb|ent)$", "")
    return found if "structure_id" in found.columns else found.withColumn("structure_id", stem)


def relative_id(found: DataFrame, base: str) -> DataFrame:
    """found with structure_id: the path below the folder base, without suffix, so that no two files share one."""
    path = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    below = F.regexp_replace(path, F.lit("^.*" + re.escape("/" + base.strip("/") + "/").replace("\\/", "/")), F.lit(""))
    return found.withColumn("structure_id", F.regexp_replace(below, r"(?i)\.(cif|mmcif|pdb|ent)$", ""))


def _parsed(found: DataFrame, schema: str, parse) -> DataFrame:
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, key, content in zip(batch["path"], batch["structure_id"], batch["content"], strict=True):
                rows = parse(path, key, bytes(content).decode("utf-8", "replace"))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return _keyed(found).select("path", "structure_id", "content").mapInPandas(run, schema)


def atom_site(found: DataFrame) -> DataFrame:
    """Atoms of mmCIF and PDB files, in file order by atom_serial."""

    def parse(path: str, structure: str, text: str) -> list[tuple]:
        try:
            rows = pdb_atoms(structure, text) if path.lower().endswith((".pdb", ".ent")) else cif_atoms(structure, text)
            error = None if rows else "no atoms"
        except (ValueError, IndexError, KeyError) as e:
            rows, error = [], f"{type(e).__name__}: {e}"
        return rows or [(structure, *[None] * 17, error)]

    return _parsed(found, ATOM_SITE, parse)


def parsed(found: DataFrame) -> DataFrame:
    """Atoms as atom_site() gives them, each with resolution, that of refine(), so that a file is parsed once for both. A
    file without atoms has one row with its error."""

    return _parsed(found, PARSED, parsed_rows)


def parsed_rows(path: str, structure: str, text: str) -> list[tuple]:
    """The rows of parsed() for one file."""
    rows, error, value = [], "no atoms", None
    try:
        if path.lower().endswith((".pdb", ".ent")):
            rows, value = pdb_atoms(structure, text), _pdb_resolution(text)
        else:
            tables = cif_tables(text)
            rows, value = _cif_rows(structure, tables), _cif_resolution(tables)
    except (ValueError, IndexError, KeyError) as e:
        error = f"{type(e).__name__}: {e}"
    return [(*r, value) for r in rows] or [(structure, *[None] * 17, error, value)]


def stage(found: DataFrame, path: str) -> DataFrame:
    """The parsed files written to path, sorted by structure so that readers skip what they do not ask for, and read again."""
    parsed(found).repartition("structure_id").sortWithinPartitions("structure_id", "atom_serial").write.mode("overwrite").parquet(path)
    return found.sparkSession.read.schema(PARSED).parquet(path)


def entity_poly(found: DataFrame) -> DataFrame:
    """Polymer entities of mmCIF files, with their sequence text and comma list of strands."""

    def parse(path: str, structure: str, text: str) -> list[tuple]:
        rows = cif_tables(text).get("_entity_poly", ())
        get = ("entity_id", "pdbx_seq_one_letter_code", "pdbx_strand_id", "type")
        return [(structure, *(r.get(k) for k in get)) for r in rows]

    return _parsed(found, ENTITY_POLY, parse)


def struct_conn(found: DataFrame) -> DataFrame:
    """Connections of mmCIF files."""

    def parse(path: str, structure: str, text: str) -> list[tuple]:
        get = ["conn_type_id"] + [f"ptnr{i}_label_{k}_id" for i in (1, 2) for k in ("asym", "seq", "comp")]
        return [(structure, *(r.get(k) for k in get)) for r in cif_tables(text).get("_struct_conn", ())]

    return _parsed(found, STRUCT_CONN, parse)


def refine(found: DataFrame) -> DataFrame:
    """Resolution of each file, from the refinement category or the REMARK 2 line; null if it has none."""

    def parse(path: str, structure: str, text: str) -> list[tuple]:
        pdb = path.lower().endswith((".pdb", ".ent"))
        return [(structure, _pdb_resolution(text) if pdb else _cif_resolution(cif_tables(text)))]

    return _parsed(found, REFINE, parse)


def main_atoms(atoms: DataFrame) -> DataFrame:
    """One atom for each residue and atom name: the alternative of highest occupancy, first in the file among equals."""
    key = ("structure_id", "model_num", "auth_asym_id", "auth_seq_id", "ins_code", "label_comp_id", "atom_name")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("occupancy").desc_nulls_last(), "atom_serial"))
    return atoms.where("error IS NULL").withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _cell(value: str | None) -> str:
    """A value as an mmCIF token."""
    if value is None:
        return "?"
    if "\n" in value or ("'" in value and '"' in value):
        return f"\n;{value}\n;\n"
    plain = value and not re.search(r"[\s'\"]", value) and value[0] not in "_#$;[]" and not re.match(r"(data_|loop_|save_|stop_|global_|[?.]$)", value, re.I)
    quote = '"' if "'" in value else "'"
    return value if plain else f"{quote}{value}{quote}"


def cif_text(name: str, tables: dict[str, list[dict[str, str | None]]]) -> str:
    """An mmCIF text of one block with the categories in order, each as a loop."""
    out = [f"data_{name}"]
    for category, rows in tables.items():
        if rows:
            fields = list(rows[0])
            out += ["#", "loop_", *(f"{category}.{field}" for field in fields)]
            out += [" ".join(_cell(row.get(field)) for field in fields) for row in rows]
    return "\n".join(out) + "\n"


def cif_texts(found: DataFrame) -> DataFrame:
    """structure_id, text of mmCIF files (path, content) with the atoms of some chains, moved; other categories stay.

    Columns chains (author chains to keep, null or empty for all), rotation (nine numbers by rows), shift (null: stay in
    place) and, if there is one, hetero (false: leave hetero atoms out) say what to do with each file. Water is dropped. A
    file without atoms gives a text without them; a PDB file gives its atoms.
    """

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, name, content, chains, turn, shift, hetero in batch[list(names)].itertuples(index=False):
                tables = _tables(path, name, bytes(content).decode("utf-8", "replace"))
                out.append((name, _changed(name, tables, chains, turn, shift, hetero)))
            yield pd.DataFrame(out, columns=["structure_id", "text"])

    names = ("path", "structure_id", "content", "chains", "rotation", "shift", "hetero")
    found = _keyed(found)
    found = found if "hetero" in found.columns else found.withColumn("hetero", F.lit(True))
    return found.select(*names).mapInPandas(convert, "structure_id string, text string")


def many_cif_texts(found: DataFrame) -> DataFrame:
    """name, text of the mmCIF files that each file's jobs ask for (array of name, chains, rotation, shift, hetero), as
    cif_texts() makes them; a file is parsed once for all its jobs, and its texts leave one by one."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content, jobs in batch[["path", "content", "jobs"]].itertuples(index=False):
                tables = _tables(path, "", bytes(content).decode("utf-8", "replace"))
                for j in jobs:
                    text = _changed(j["name"], tables, j["chains"], j["rotation"], j["shift"], j["hetero"])
                    yield pd.DataFrame([(j["name"], text)], columns=["name", "text"])

    return found.select("path", "content", "jobs").mapInPandas(convert, "name string, text string")


def _tables(path: str, name: str, text: str) -> dict[str, list[dict[str, str | None]]]:
    pdb = path.lower().endswith((".pdb", ".ent"))
    return {"_atom_site": [_site(r) for r in pdb_atoms(name, text)]} if pdb else cif_tables(text)


def _changed(name: str, tables: dict[str, list[dict[str, str | None]]], chains, turn, shift, hetero) -> str:
    """The mmCIF text of tables with the atoms of some chains, without water and, if asked, hetero atoms, moved."""
    rows, keep = [], set() if chains is None else set(chains)
    for row in tables.get("_atom_site", ()):
        if row.get("label_comp_id") == "HOH" or keep and (row.get("auth_asym_id") or row.get("label_asym_id")) not in keep:
            continue
        if not hetero and row.get("group_PDB") == "HETATM":
            continue
        if turn is not None and shift is not None:
            at = [_number(row.get(f"Cartn_{c}")) or 0.0 for c in "xyz"]
            moved = [sum(turn[3 * i + j] * at[j] for j in range(3)) + shift[i] for i in range(3)]
            row = row | {f"Cartn_{c}": f"{v:.3f}" for c, v in zip("xyz", moved, strict=True)}
        rows.append(row)
    return cif_text(name.rsplit("/", 1)[-1], tables | ({"_atom_site": rows} if "_atom_site" in tables else {}))


def _site(row: tuple) -> dict[str, str | None]:
    """An atom of a PDB file as a row of the mmCIF category."""
    _, model, serial, group, label, auth, comp, seq, auth_seq, ins, atom, alt, occupancy, b_factor, element, x, y, z, _ = row
    plain = {"group_PDB": group, "id": serial + 1, "type_symbol": element, "label_atom_id": atom, "label_alt_id": alt, "label_comp_id": comp, "label_asym_id": label, "label_seq_id": seq}
    plain |= {"pdbx_PDB_ins_code": ins, "Cartn_x": x, "Cartn_y": y, "Cartn_z": z, "occupancy": occupancy, "B_iso_or_equiv": b_factor, "auth_seq_id": auth_seq, "auth_asym_id": auth, "pdbx_PDB_model_num": model}
    return {k: None if v is None else str(v) for k, v in plain.items()}
