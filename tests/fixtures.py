"""Small synthetic landing trees (5-50 rows per file) covering the awkward cases of the price files."""

from __future__ import annotations

import io
import os
import zipfile

HEADER_T1 = "Année;Corps de métiers;Activité;Produit;Variété;Prix moyens des matériaux de construction TTC (DH)"
HEADER_T3 = "Année;Corps de métiers;Activité;Produit;Indices des prix moyens des matériaux de construction"

PROVINCES = [
    ("Code province", "Noms_Prov", "Nom_ProvAr"),
    ("1511", "PRÉFECTURE DE FÈS", "عمالة فاس"),
    ("1131", "PROVINCE DE KÉNITRA", "إقليم القنيطرة"),
    ("10261", "PROVINCE DE TAN-TAN", "إقليم طانطان"),
    ("12066", "PROVINCE D'AL HAOUZ", "إقليم الحوز"),
    ("4111", "PRÉFECTURE DE MARRAKECH", "عمالة مراكش"),
    ("3311", "PROVINCE DE SETTAT", "إقليم سطات"),
]
REGIONS = [("code_region", "nom_region"), ("1", "FÈS-MEKNÈS"), ("10", "GUELMIM-OUED NOUN"), ("12", "MARRAKECH-SAFI"),
           ("4", "RABAT-SALÉ-KÉNITRA"), ("3", "CASABLANCA-SETTAT")]
COMMUNES = [("code_commune", "nom_commune", "code_province"), ("151101", "FÈS MÉDINA", "1511"),
            ("1131010", "KÉNITRA", ""), ("4111001", "MÉNARA", "4111")]


def _w(path: str, text: str, encoding: str = "utf-8", bom: bool = False) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode(encoding)
    if bom:
        data = b"\xef\xbb\xbf" + data
    with open(path, "wb") as f:
        f.write(data)


def price_rows(years=(2019, 2020), products=(("Béton", "Béton B25"), ("Acier", "Acier HA8")), base=100.0):
    rows = []
    for y in years:
        for i, (prod, var) in enumerate(products):
            rows.append(f"{y};Gros oeuvre;Maçonnerie;{prod};{var};{str(base + i + (y - 2019) * 3).replace('.', ',')}")
    return rows


def build_landing(root: str) -> dict[str, str]:
    """Write a landing tree and a reference folder; return their paths."""
    land = os.path.join(root, "landing")
    refs = os.path.join(root, "refs")
    _w(f"{land}/NATIONAL/maroc_T1.csv", "\n".join([HEADER_T1, *price_rows()]) + "\n", bom=True)
    _w(f"{land}/MS/ms_T3.csv", "\n".join([HEADER_T3, "2020;Gros oeuvre;Maçonnerie;Béton;101,5", "2021;Gros oeuvre;Maçonnerie;Acier;99,1"]) + "\n")
    _w(f"{land}/FES/fes_T1.csv", "\n".join([HEADER_T1, *price_rows(base=120.0), "2020.0;Gros oeuvre;Maçonnerie;Béton;Béton B25;1,0",
                                           ";Gros oeuvre;Maçonnerie;Béton;Béton B25;2,0"]) + "\n")
    _w(f"{land}/x/region-marrakech-safi_CSV/ALHAOUZ/alhaouz_T1.csv", "\n".join([HEADER_T1, *price_rows(base=90.0)]) + "\n",
       encoding="cp1252")
    _w(f"{land}/KENITRA/kenitra_T1.csv", "\n".join([HEADER_T1.replace(";", ","), *[r.replace(",", ".").replace(";", ",") for r in price_rows(base=110.0)]]) + "\n")
    _w(f"{land}/TANTAN/tantan_T1.csv", "\n".join([HEADER_T1, *price_rows(base=130.0), "2020;Gros oeuvre;Maçonnerie;Béton;Béton B25;1;extra"]) + "\n")
    _w(f"{land}/MARRAKECH/marrakech_T1.csv", "\n".join([HEADER_T1, "2020;Gros oeuvre;Maçonnerie;Béton"]) + "\n")
    _w(f"{land}/CASA/casa_T1.csv", HEADER_T1 + "\n")  # header only
    _w(f"{land}/EMPTY/empty_T1.csv", "")
    _w(f"{land}/maroc_T3.csv", "\n".join([HEADER_T3, "2020;Gros oeuvre;Maçonnerie;Béton;100"]) + "\n")
    # a zipped drop with one more city
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("SETTAT/settat_T1.csv", ("\n".join([HEADER_T1, *price_rows(base=140.0)]) + "\n").encode("utf-8"))
    os.makedirs(f"{land}/drops", exist_ok=True)
    with open(f"{land}/drops/drop_2025.zip", "wb") as f:
        f.write(buf.getvalue())
    weights = os.path.join(root, "weights")
    _w(f"{weights}/ponderations_villes_regions_output.csv",
       "Ville;Variété;2019;2020\nFES;Béton B25;0,25;0,3\nKENITRA;Acier HA8;0,75;\nZZZ;Béton B25;1;1\n", bom=True)
    _w(f"{weights}/ponderation_MC_prixindice.csv", "Corps;Poids\nGros oeuvre;0,6\n")
    _w(f"{refs}/province.csv", "\n".join(";".join(r) for r in PROVINCES) + "\n", bom=True)
    _w(f"{refs}/region.csv", "\n".join(";".join(r) for r in REGIONS) + "\n")
    _w(f"{refs}/commune.csv", "\n".join(";".join(r) for r in COMMUNES) + "\n")
    return {"landing": land, "refs": refs, "weights": weights}
