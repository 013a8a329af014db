"""The registers that are read, as a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = {
    "ord": "int", "source_key": "string", "regulator": "string", "type": "string", "category": "string", "category_return": "string", "status_override": "string", "section": "string", "intm_id": "string",
    "label_hint": "string", "english": "boolean", "paginate": "boolean", "classification": "boolean", "split": "boolean", "page": "string",
}
#: Pages that several registers are read from, by type of register: the folder in which they are staged. Others have a folder of their own name.
PAGES = {"rbi_banks_custom": "rbi_banks", "rbi_state_coop_custom": "rbi_banks", "rbi_pss_custom": "rbi_pss"}


def row(source_key: str, regulator: str, type: str, category: str, category_return: str, **options) -> dict:
    return {"source_key": source_key, "regulator": regulator, "type": type, "category": category, "category_return": category_return, "page": PAGES.get(type, source_key), **options}


# Key, regulator, type, category of the regulator, category of the return, options.
CATALOG = [
    row("rbi_nbfc", "RBI", "xlsx_direct", "NBFC", "Other NBFCs", classification=True),
    row("rbi_nbfc_cancelled", "RBI", "xlsx_direct", "NBFC", "Other NBFCs", classification=True, status_override="Cancelled"),
    row("rbi_pss_operating", "RBI", "rbi_pss_custom", "PSS Operating", "Other Financial Entities", section="operating"),
    row("rbi_pss_revoked", "RBI", "rbi_pss_custom", "PSS Revoked", "Other Financial Entities", section="revoked", status_override="Revoked"),
    row("rbi_pss_ceased", "RBI", "rbi_pss_custom", "PSS Ceased", "Other Financial Entities", section="ceased", status_override="Ceased"),
    row("rbi_pss_surrendered", "RBI", "rbi_pss_custom", "PSS Surrender/Cancelled", "Other Financial Entities", section="surrendered", status_override="Surrendered"),
    row("rbi_pss_cancelled", "RBI", "rbi_pss_custom", "PSS Surrender/Cancelled", "Other Financial Entities", section="cancelled_regulatory", status_override="Cancelled"),
    row("nhb_hfc", "NHB", "pdf_link", "HFCs", "Housing Finance Companies"),
    row("rbi_bank_private", "RBI", "rbi_banks_custom", "Private Sector Banks in India", "Banks", section="private"),
    row("rbi_bank_public", "RBI", "rbi_banks_custom", "Public Sector Banks in India", "Banks", section="public"),
    row("rbi_bank_lab", "RBI", "rbi_banks_custom", "Local Area Banks (LAB)", "Banks", section="lab"),
    row("rbi_bank_sfb", "RBI", "rbi_banks_custom", "Small Finance Banks (SFB)", "Banks", section="sfb"),
    row("rbi_bank_pb", "RBI", "rbi_banks_custom", "Payments Banks (PB)", "Banks", section="pb"),
    row("rbi_bank_rrb", "RBI", "rbi_banks_custom", "Regional Rural Banks in India", "Banks", section="rrb"),
    row("rbi_bank_foreign", "RBI", "rbi_banks_custom", "Foreign banks", "Banks", section="foreign"),
    row("rbi_financial_institutions", "RBI", "manual", "Financial Institutions in India", "Other Financial Entities"),
    row("rbi_bank_state_coop", "RBI", "rbi_state_coop_custom", "State Co-operative Banks", "Banks", section="scheduled"),
    row("rbi_bank_scheduled_urban_coop", "RBI", "pdf_link", "Scheduled Urban Co-operative Banks", "Banks"),
    row("rbi_bank_non_scheduled_urban_coop", "RBI", "pdf_link", "Non-Scheduled Urban Co-operative Banks", "Banks"),
    row("rbi_bank_non_scheduled_state_coop", "RBI", "rbi_state_coop_custom", "Non-Scheduled State Co-operative Banks", "Banks", section="non_scheduled"),
    row("irdai_life", "IRDAI", "html_table", "Life Insurance Companies", "Insurance Companies"),
    row("irdai_non_life", "IRDAI", "html_table", "Non-Life Insurance Companies", "Insurance Companies"),
    row("irdai_health", "IRDAI", "html_table", "Health insurer", "Insurance Companies"),
    row("irdai_reinsurers", "IRDAI", "html_table", "Re insurers", "Other Financial Entities"),
    row("irdai_reinsurance_branches", "IRDAI", "html_table", "Foreign Reinsurance Branches", "Other Financial Entities", paginate=True, english=True),
    row("irdai_brokers", "IRDAI", "html_table", "Brokers", "Other Financial Entities", paginate=True, english=True),
    row("irdai_surveyors", "IRDAI", "html_table", "Surveyors", "Other Financial Entities", paginate=True, english=True),
    row("irdai_web_aggregators", "IRDAI", "html_table", "Web-aggregators", "Other Financial Entities", paginate=True, english=True),
    row("irdai_insurance_repository", "IRDAI", "html_table", "Insurance-repository", "Other Financial Entities", paginate=True, english=True),
    row("irdai_imf", "IRDAI", "html_table", "Imf", "Other Financial Entities", paginate=True, english=True),
    row("irdai_tpa", "IRDAI", "aspx_dynamic", "Third-party-administrators", "Other Financial Entities", english=True),
    row("irdai_ca_insurer", "IRDAI", "html_table", "CA-Insurer-List", "Other Financial Entities"),
    row("sebi_credit_rating", "SEBI", "sebi_intermediary_custom", "Credit Rating Agency", "Other Financial Entities", intm_id="7", label_hint=r"credit\s+rating"),
    row("sebi_venture_capital", "SEBI", "sebi_intermediary_custom", "Venture Capital Funds", "Investment in Overseas JV Company", intm_id="21", label_hint=r"venture\s+capital\s+fund"),
    row("sebi_foreign_vc", "SEBI", "sebi_intermediary_custom", "Registered Foreign Venture Capital Investors", "Investment in Overseas JV Company", intm_id="25", label_hint=r"foreign\s+venture"),
    row("sebi_investment_adviser", "SEBI", "sebi_intermediary_custom", "Investment Adviser", "Other Financial Entities", intm_id="13", label_hint=r"investment\s+advis"),
    row("sebi_broker_equity", "SEBI", "sebi_intermediary_custom", "Stock Brokers in equity segment", "Other Financial Entities", intm_id="30"),
    row("sebi_broker_equity_derivative", "SEBI", "sebi_intermediary_custom", "Stock Brokers in Equity Derivative Segment", "Other Financial Entities", intm_id="31"),
    row("sebi_broker_commodity_derivative", "SEBI", "sebi_intermediary_custom", "Stock Brokers in Commodity Derivative", "Other Financial Entities", intm_id="2"),
    row("sebi_broker_debt", "SEBI", "sebi_intermediary_custom", "Stock Brokers in Debt Segement", "Other Financial Entities", intm_id="37"),
    row("sebi_broker_interest_rate_derivative", "SEBI", "sebi_intermediary_custom", "Stock Brokers in Interest Rate Derivative", "Other Financial Entities", intm_id="38"),
    row("sebi_broker_currency_derivative", "SEBI", "sebi_intermediary_custom", "Stock Brokers in Currency Derivative Segment", "Other Financial Entities", intm_id="32"),
    row("sebi_portfolio_managers", "SEBI", "sebi_intermediary_custom", "Registered Portfolio Managers", "Other Financial Entities", intm_id="33", label_hint=r"portfolio\s+manager"),
    row("sebi_mutual_funds", "SEBI", "sebi_intermediary_custom", "Mutual Funds", "Mutual Fund Companies", intm_id="23", label_hint=r"mutual\s+fund"),
    row("sebi_dp_cdsl", "SEBI", "sebi_intermediary_custom", "Depository Participants - CDSL", "Other Financial Entities", intm_id="18", label_hint="cdsl"),
    row("sebi_dp_nsdl", "SEBI", "sebi_intermediary_custom", "Depository Participants - NSDL", "Other Financial Entities", intm_id="19", label_hint="nsdl"),
    row("sebi_merchant_bankers", "SEBI", "sebi_intermediary_custom", "Merchant Banker", "Other Financial Entities", intm_id="9", label_hint=r"merchant\s+banker"),
    row("sebi_debenture_trustee", "SEBI", "sebi_intermediary_custom", "Debentures Trustee", "Other Financial Entities", intm_id="6", label_hint=r"debentures?\s+trustee"),
    row("sebi_custodians", "SEBI", "sebi_intermediary_custom", "Registered Custodians", "Other Financial Entities", intm_id="27", label_hint="custodian"),
    row("sebi_share_transfer_agent", "SEBI", "sebi_intermediary_custom", "Share Transfer Agent", "Other Financial Entities", intm_id="10", label_hint=r"(?:share\s+transfer)|(?:registrar)"),
    row("sebi_banker_to_issue", "SEBI", "sebi_intermediary_custom", "Banker to an Issue", "Other Financial Entities", intm_id="5", label_hint="banker.*issue"),
    row("pfrda_pension_fund", "PFRDA", "aspx_dynamic", "Pension Fund", "Pension Funds", split=True),
    row("amfi_amc", "AMFI", "amfi_members", "Mutual Funds", "Mutual Fund Companies", english=True),
    row("amfi_distributor", "AMFI", "manual", "Mutual Fund Distributor", "Other Financial Entities"),
]
# Names added where the scrape of a register lacks them.
SEEDS = {
    "irdai_health": [
        "Star Health and Allied Insurance Company Limited", "Care Health Insurance Limited", "Niva Bupa Health Insurance Company Limited", "Aditya Birla Health Insurance Company Limited",
        "ManipalCigna Health Insurance Company Limited", "Galaxy Health and Allied Insurance Company Limited", "Narayana Health Insurance Limited",
    ]
}
# Words of state co-operative banks that are not scheduled.
NON_SCHEDULED = ["Andaman", "Arunachal", "Assam", "Chandigarh", "Daman", "Jammu", "Jharkhand", "Manipur", "Mizoram", "Nagaland"]
# Patterns for the pension funds' page.
PENSION = {
    "tables": r"name\s+of\s+(the\s+)?pension|pension\s+fund\s+(manager|name|company)", "keyword": "pension|retirement",
    "heading": r"^list\s+of\s+pension\s+funds", "stop": r"^(public\s+disclosures|schemes|return\s+of|investment\s+management|note)",
}

def sources(spark: SparkSession) -> DataFrame:
    """The catalog in its order; options that a register lacks are null, flags false."""
    value = lambda r, f, kind: r.get(f, False if kind == "boolean" else None)
    rows = [tuple(value({"ord": i, **r}, f, kind) for f, kind in FIELDS.items()) for i, r in enumerate(CATALOG)]
    return spark.createDataFrame(rows, ", ".join(f"{f} {kind}" for f, kind in FIELDS.items()))


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, i, n) for k, names in SEEDS.items() for i, n in enumerate(names)], "source_key string, pos int, name string")


def months(since, until):
    """First days of the months from one date column to another, both included; null if the first is later."""
    return F.when(since <= until, F.sequence(F.trunc(since, "MM"), F.trunc(until, "MM"), F.expr("interval 1 month")))
