"""A small bank of our own with planted defects, and its numbers worked out in plain Python.

``TABLES`` are the ten extracts as delivered (text). ``expected`` recomputes positions, marts and
reports row by row with fractions, from the rules alone and without any Spark code.
"""

from __future__ import annotations

import csv
import os
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

AS_OF, LOAN_BOOK = "2024-06-30", "CEDAR"

TABLES = {
    "portfolios": """portfolio_id,portfolio_name,legal_entity,asset_class_scope,currency
ALPHA,Alpha growth,Harbor Fund ,equity,EUR
BRAVO, Bravo income,Harbor Fund,bonds,EUR
CEDAR,Cedar lending,Quay Bank,loans,EUR
DELTA,Delta mixed,Mill Pension,mixed,EUR
""",
    "instruments": """instrument_id,isin,instrument_type,issuer_id,currency
Q1, zz00q1,equity,N1,EUR
Q2,ZZ00Q2,equity,N2,CHF
Q3,ZZ00Q3,corporate_bond,N2,usd
Q4,ZZ00Q4,equity,N3,EUR
Q5,ZZ00Q5,corporate_bond,N4,EUR
Q6,ZZ00Q6,equity,N5,EUR
Q7,ZZ00Q7,equity,N6,EUR
Q8,ZZ00Q8,corporate_bond,N7,EUR
Q9,ZZ00Q9,equity,N8,EUR
""",
    "issuers": """issuer_id,lei,issuer_name,country,nace_sector
N1,LEI-1,Net Makers,FR,C13
N2,LEI-2,Tar Works,PT,C20
N3,,Sail Loft,DK,C13
N4,LEI-4,Rope Walk,NL,C13
N5, ,Salt Pans,ES,B08
N6,LEI-6,Ice House,IS,C10
N7,LEI-7,Light Keeper,IE,H52
N8,LEI-8,Ferry Line,GR,H50
""",
    "holdings": """portfolio_id,instrument_id,as_of_date,quantity,market_value,currency
ALPHA,Q1,2024-06-30,10,90000,EUR
ALPHA,Q1,2024-06-30,11,100000,EUR
ALPHA,Q1,2023-12-31,9,80000,EUR
ALPHA,Q2,2024-06-30,4,40000, CHF
ALPHA,Q4,2024-06-30,5,25000,EUR
ALPHA,Q7,2024-06-30,6,30000.5,EUR
BRAVO,Q3,2024-06-30,5,50000,usd
BRAVO,Q5,2024-06-30,1,12500,EUR
BRAVO,Q8,2024-06-30,2,20000,XYZ
BRAVO,Q1,2024-06-30,2,NaN,EUR
DELTA,Q1,2024-06-30,1,8000,EUR
DELTA,Q6,2024-06-30,1,6400,EUR
DELTA,Q9,2024-06-30,1,1000,EUR
DELTA,Q2,2024-06-30,1,,EUR
DELTA,Q3
""",
    "loans": """loan_id,borrower_issuer_id,as_of_date,outstanding_amount,currency,loan_purpose
K1,N1,2024-06-30,50000,EUR,boats
K1,N1,2023-06-30,45000,EUR,boats
K2,N3,2024-06-30,30000,EUR,cloth
K3,N6,2024-06-30,10000,CHF,ice
K4,N2,2024-06-30,-5,EUR,tar
" ",N2,2024-06-30,77,EUR,tar
K6,,2024-06-30,7000,EUR,unknown
""",
    "company_financials": """issuer_id,fiscal_year,evic_eur,total_assets_eur,revenue_eur
N1,2024,2000000,5000000,400000
N1,2023,1900000,4900000,390000
N2,2024,8000000,9000000,1600000
N3,2024,0,3000000,250000
N4,2024,1250000,2000000,500000
N5,2024,640000,1000000,0
N6,2024,3200000,4000000,800000
N7,2024,5000000,6000000,2500000
""",
    "vendor_emissions": """provider_entity_id,fiscal_year,scope1_tco2e,scope2_tco2e,scope3_tco2e,emission_data_source,esg_rating,fossil_fuel_flag
V1,2024,100,20,300,verified,A,0
V1,2023,900,90,900,verified,A,0
V2,2024,4000,500,,reported,BB,1
V2,2024,4000,500,,reported,BB,1
V3,2024,60,40,100,reported, ,0
V5,2024,,10,,estimated,CCC,1
V7,2024,8,2,5,estimated,AA,0
""",
    "taxonomy_data": """issuer_id,fiscal_year,taxonomy_eligible_share,taxonomy_aligned_share
N1,2024,0.5,0.25
N2,2024,0.2,0.4
N3,2024,0.1,0.1
N6,2024,,0.1
N7,2024,0.75,0.6
""",
    "fx_rates": """currency,as_of_date,rate_to_eur
EUR,30jun2024,1.0
CHF,30JUN2024,1.05
usd,30JUN2024,0.9
SEK,2024-06-30,0.087
CHF,31DEC2023,1.5
""",
    "crosswalk": """issuer_id,provider_entity_id
N1,V1
N2,V2
N3,V3
N4,V404
N5,V5
N7,V7
N8,
""",
}

#: (source, reason, business key, rows): what the ledger must hold, found by reading the tables.
LEDGER = [
    ("fx_rates", "unparseable_sas_date9", "SEK|", 1),
    ("holdings", "duplicate_key", "ALPHA|Q1|2024-06-30", 1),
    ("holdings", "malformed_line", "DELTA|Q3|", 1),
    ("holdings", "missing_market_value", "DELTA|Q2|2024-06-30", 1),
    ("holdings", "non_finite_number", "BRAVO|Q1|2024-06-30", 1),
    ("loans", "missing_key", "|2024-06-30", 1),
    ("loans", "negative_outstanding_amount", "K4|2024-06-30", 1),
    ("taxonomy_data", "aligned_gt_eligible", "N2|2024", 1),
    ("taxonomy_data", "missing_taxonomy_share", "N6|2024", 1),
    ("vendor_emissions", "duplicate_key", "V2|2024", 1),
]

STATUS = {"N4": "orphan_provider", "N6": "unmapped_issuer", "N8": "unmapped_issuer"}  # the others are mapped
ENTITY = {"ALPHA": "Harbor Fund", "BRAVO": "Harbor Fund", "CEDAR": "Quay Bank", "DELTA": "Mill Pension"}


def write_csv(folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for name, text in TABLES.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.write(text)


def rounded(x: Fraction | None, places: int) -> float | None:
    if x is None:
        return None
    d = Decimal(x.numerator * 10**places) / Decimal(x.denominator)
    return float(d.to_integral_value(ROUND_HALF_UP).scaleb(-places))


def rows(name: str) -> list[dict]:
    return [{k: (v or "").strip() for k, v in r.items()} for r in csv.DictReader(TABLES[name].splitlines())]


def positions() -> list[dict]:
    """The valid positions of the as-of date with everything known about them."""
    rate = {"EUR": Fraction(1), "CHF": Fraction("1.05"), "usd": Fraction("0.9")}
    num = lambda x: Fraction(x) if x else None
    fin = {r["issuer_id"]: r for r in rows("company_financials") if r["fiscal_year"] == "2024"}
    vendor = {r["provider_entity_id"]: r for r in rows("vendor_emissions") if r["fiscal_year"] == "2024"}
    provider = {r["issuer_id"]: r["provider_entity_id"] for r in rows("crosswalk")}
    instrument = {r["instrument_id"]: r for r in rows("instruments")}
    kinds = {"equity": "listed_equity", "corporate_bond": "corporate_bond"}
    raw = []
    for r in rows("holdings"):
        dropped = r["market_value"] in ("", "NaN", "90000") or r["as_of_date"] != AS_OF
        if not dropped:
            i = instrument[r["instrument_id"]]
            raw.append((r["portfolio_id"], i["issuer_id"], kinds[i["instrument_type"]], r["market_value"], r["currency"]))
    for r in rows("loans"):
        if r["as_of_date"] == AS_OF and r["loan_id"] and not r["outstanding_amount"].startswith("-"):
            raw.append((LOAN_BOOK, r["borrower_issuer_id"], "business_loan", r["outstanding_amount"], r["currency"]))
    tax = {"N1": ("0.5", "0.25"), "N3": ("0.1", "0.1"), "N7": ("0.75", "0.6")}
    out = []
    for book, issuer, kind, amount, currency in raw:
        f, v = fin.get(issuer, {}), vendor.get(provider.get(issuer, ""), {})
        status = STATUS.get(issuer, "mapped") if issuer else None
        scopes = [num(v.get(f"scope{i}_tco2e")) for i in (1, 2, 3)]
        emitted = sum((s or 0 for s in scopes), Fraction(0)) if status == "mapped" else None
        exposure = Fraction(amount) * rate.get(currency, Fraction(1))
        size = num(f.get("total_assets_eur" if kind == "business_loan" else "evic_eur"))
        share = exposure / size if size and size > 0 else None
        source = v.get("emission_data_source")
        known = [s is not None for s in scopes]
        score = 5
        if status in (None, "mapped"):
            if source == "estimated":
                score = 4
            elif source in ("verified", "reported") and all(known):
                score = 1 if source == "verified" else 2
            elif source == "reported" and all(known[:2]):
                score = 3
        financed = rounded(share * emitted, 6) if share is not None and emitted is not None else None
        cause = status if status not in (None, "mapped") else None
        cause = cause or ("zero_or_missing_denominator" if share is None else "missing_esg_data" if financed is None else "mapped")
        flag = {"1": 1, "0": 0}.get(v.get("fossil_fuel_flag", "")) if status == "mapped" else None
        out.append(
            {
                "book": book, "issuer": issuer or None, "kind": kind, "x": exposure, "share": share, "emitted": emitted,
                "financed": None if financed is None else Fraction(repr(financed)), "score": score, "cause": cause,
                "revenue": num(f.get("revenue_eur")), "flag": flag, "tax": [Fraction(t) for t in tax.get(issuer, ("0", "0"))],
            }
        )
    return out


def expected() -> dict[str, dict]:
    """Report id -> key -> compared columns."""
    pos = positions()
    group = lambda key: {k: [p for p in pos if key(p) == k] for k in {key(p) for p in pos}}
    total = lambda ps, f=lambda p: p["x"]: sum((f(p) for p in ps if f(p) is not None), Fraction(0))
    out: dict[str, dict] = defaultdict(dict)
    for rid, kind, amount in (
        ("R01", "listed_equity", "market_value_eur"),
        ("R02", "corporate_bond", "market_value_eur"),
        ("R03", "business_loan", "outstanding_eur"),
    ):
        for (book, issuer, k), ps in group(lambda p: (p["book"], p["issuer"], p["kind"])).items():
            if k == kind:
                has = any(p["financed"] is not None for p in ps)
                shares = [p["share"] for p in ps if p["share"] is not None]
                out[rid][book, issuer] = {
                    amount: rounded(total(ps), 2),
                    "financed_emissions_tco2e": rounded(total(ps, lambda p: p["financed"]), 6) if has else None,
                    "attribution_factor": rounded(max(shares), 10) if shares else None,
                    "pcaf_score": rounded(Fraction(sum(p["score"] for p in ps), len(ps)), 4),
                    "has_emissions_flag": int(has),
                }
    for (book, kind), ps in group(lambda p: (p["book"], p["kind"])).items():
        covered = total([p for p in ps if p["financed"] is not None])
        out["R04"][book, kind] = {
            "weighted_pcaf_score": rounded(total(ps, lambda p: p["x"] * p["score"]) / total(ps), 4),
            "coverage_pct": rounded(100 * covered / total(ps), 4),
        }
    entity: dict[str, list] = defaultdict(list)
    for book, ps in group(lambda p: p["book"]).items():
        aum, usable = total(ps), [p for p in ps if p["financed"] is not None and p["revenue"]]
        waci = None
        if usable:
            waci = rounded(total(usable, lambda p: p["emitted"] / (p["revenue"] / 10**6) * p["x"]) / total(usable), 6)
            out["R05"][book,] = {
                "waci_tco2e_per_m_eur": waci,
                "carbon_footprint_tco2e_per_m_eur": rounded(total(usable, lambda p: p["financed"]) / (aum / 10**6), 6),
                "aum_eur": float(aum),
            }
        entity[ENTITY[book]].append((ps, aum, waci))
        fossil = rounded(total([p for p in ps if p["flag"] == 1]), 2)
        out["R07"][book,] = {
            "fossil_fuel_market_value_eur": fossil,
            "fossil_fuel_exposure_pct": rounded(100 * Fraction(repr(fossil)) / aum, 6),
            "flag_coverage_pct": rounded(100 * total([p for p in ps if p["flag"] is not None]) / aum, 4),
        }
        eligible, aligned = (total(ps, lambda p, i=i: p["x"] * p["tax"][i]) for i in (0, 1))
        out["R08"][book,] = {
            "eligible_share_pct": rounded(100 * eligible / aum, 6),
            "aligned_share_of_eligible_pct": rounded(100 * aligned / eligible if eligible else Fraction(0), 6),
            "aligned_share_of_aum_pct": rounded(100 * aligned / aum, 6),
        }
    for name, books in entity.items():
        everything = [p for ps, _, _ in books for p in ps]
        pai1 = rounded(total(everything, lambda p: p["financed"]), 6)
        out["R06"][name, "PAI1_ghg_emissions_tco2e"] = {"pai_value": pai1}
        out["R06"][name, "PAI2_carbon_footprint_tco2e_per_m_eur"] = {
            "pai_value": rounded(Fraction(repr(pai1)) / (total(everything) / 10**6), 6)
        }
        known = [(aum, Fraction(repr(w))) for _, aum, w in books if w is not None]
        out["R06"][name, "PAI3_ghg_intensity_tco2e_per_m_eur"] = {
            "pai_value": rounded(sum(a * w for a, w in known) / sum(a for a, _ in known), 6)
        }
    for cause, ps in group(lambda p: p["cause"]).items():
        out["R09"][cause,] = {
            "row_count": len(ps),
            "market_value_eur": rounded(total(ps), 2),
            "share_of_aum_pct": rounded(100 * total(ps) / total(pos), 6),
        }
    return dict(out)


#: Key columns per report.
KEYS = {
    **dict.fromkeys(("R01", "R02", "R03"), ("portfolio_id", "issuer_id")),
    "R04": ("portfolio_id", "asset_class"),
    **dict.fromkeys(("R05", "R07", "R08"), ("portfolio_id",)),
    "R06": ("legal_entity", "pai_indicator"),
    "R09": ("gap_cause",),
}
