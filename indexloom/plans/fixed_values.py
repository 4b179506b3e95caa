"""Codes and labels the published index is defined by."""

from __future__ import annotations

from indexloom.operators.lookups import StatusRule

SECTOR_BY_CARRIER = {
    "EK": "Lon SE", "HO": "Lon SE", "HQ": "Lon SE", "HS": "Lon SE", "HT": "Lon SE",
    "HU": "Lon SE", "HW": "Lon SE", "HY": "Lon SE", "HZ": "Lon SE", "EX": "Lon SE",
    "EA": "Regional", "EI": "Regional", "EJ": "Regional", "HA": "Regional", "HC": "Regional",
    "HD": "Regional", "HE": "Regional", "HL": "Regional", "ES": "Regional",
    "EC": "Long D", "EH": "Long D", "HB": "Long D", "HF": "Long D", "HI": "Long D", "HK": "Long D", "HM": "Long D",
}

TICKET_TYPE_BY_GROUP = {
    "PG01": "Full", "PG05": "Full",
    "PG02": "Reduced", "PG03": "Reduced", "PG06": "Reduced", "PG07": "Reduced",
    "PG04": "Season", "PG08": "Season",
}

CLASS_BY_DIGIT = {"1": "1", "2": "2", "9": "2"}

PRODUCT_PATTERN = "1[A-Z][A-Z][A-Z]|2[A-Z][A-Z][A-Z]"

REGULATED_CARRIERS = (
    "SCR", "LER", "GWR", "GXR", "IEC", "IWC", "LTS", "MML", "NCH", "NLR", "NSC", "NSE", "SWT", "NIW", "RCL", "RMS",
    "RWB", "TPE", "HUL", "IXC", "FCC", "NTH", "GWA", "GCR", "RNE", "RNW", "PDR", "PSV", "PWS", "PGM", "PMR", "PSC",
    "PSY", "PTW", "PWM", "DBA", "NFD", "LRC", "LBR", "SMR", "ANG", "GER", "NTT", "RCV", "RWW", "TLK", "WGN",
)

REGULATED_PRODUCTS = (
    "2MTA", "2MTB", "2MTE", "2MTJ", "2MTK", "2MTN", "2VQA", "2MQA", "2MSA", "2MSH", "2MSL", "2MSW",
    "2MTH", "2MTL", "2MTW", "2CGE", "2CGJ", "2CGK", "2CGN", "2CGO", "2CGS", "2CGT", "2OBC", "2OBD",
    "2OBE", "2OBF", "2OCH", "2OCI", "2OCJ", "2OCL", "2OCN", "2OEH", "2CIC", "2CID", "2CIE", "2CIF",
)

EXCEPTION_PRODUCTS = ("2ADA", "2BDY")
UNREGULATED_CLASSES = ("1",)
UNREGULATED_CARRIERS = ("EC", "HM")

# From weakest to strongest.
STATUS_RULES = (
    StatusRule("toc", "flag2", REGULATED_CARRIERS, "Regulated_by_TOC"),
    StatusRule("products", "product", REGULATED_PRODUCTS, "Regulated_by_Product"),
    StatusRule("exceptions", "product", EXCEPTION_PRODUCTS, "Unregulated_by_Product"),
    StatusRule("class", "class", UNREGULATED_CLASSES, "Unregulated_by_Class"),
    StatusRule("pcc", "carrier", UNREGULATED_CARRIERS, "Unregulated_by_PCC"),
)
STATUS_START = "Not Assigned"
STATUS_COLLAPSE = {
    "Not Assigned": "Unregulated",
    "Unregulated_by_Product": "Unregulated",
    "Unregulated_by_Class": "Unregulated",
    "Unregulated_by_PCC": "Unregulated",
    "Regulated_by_TOC": "Regulated",
    "Regulated_by_Product": "Regulated",
}

# Products left out of the price side of the index.
EXCLUDED_PRODUCTS = ("2MTC", "2MTD", "2MTF", "2MTG")
# Products whose regulated revenue is checked by origin and destination.
CHECKED_PRODUCTS = ("2AAA", "2BAF", "2BFP")

WEIGHT_LIMIT = 500_000
CHANGE_LIMIT = 20.0

FIRST_USAGE_QUARTER = "2002-03 Quarter 1"
EXCLUDED_USAGE_SOURCE = 99999
USAGE_SECTORS = ("Long-distance", "London and South East", "Regional", "Non-franchised")
USAGE_NAMES = {
    "Long-distance": "Long distance",
    "London and South East": "London and South East",
    "Regional": "Regional",
    "All operators": "All operators",
}
USAGE_TOTAL_PARTS = ("Long-distance", "London and South East", "Regional")

TICKET_LOOKUP_COLUMNS = ("Fares ticket type code", "Lennon product code (CTOT)")
