"""Rule sets as data. Keywords, units, prices and labels that results must agree on."""

# Units to metric tons.
UNITS = {
    "metric_ton": 1.0, "metric_tons": 1.0, "tonne": 1.0, "tonnes": 1.0, "t": 1.0, "mt": 1.0, "ton": 0.907185, "tons": 0.907185, "short_ton": 0.907185,
    "long_ton": 1.01605, "kg": 0.001, "kilogram": 0.001, "kilograms": 0.001, "lb": 0.000453592, "lbs": 0.000453592, "pound": 0.000453592, "pounds": 0.000453592, "cwt": 0.0453592,
}

# Units to tons as government feeds use them.
GOV_UNITS = {"pounds": 0.000453592, "lbs": 0.000453592, "lb": 0.000453592, "kg": 0.001, "kilograms": 0.001, "grams": 0.000001, "g": 0.000001, "tons": 1.0, "t": 1.0, "tonnes": 1.0}

# Price units: tons in one unit.
PRICE_UNITS = {"lb": 0.000453592, "kg": 0.001, "ton": 0.907185, "mt": 1.0, "metric_ton": 1.0, "cwt": 0.0453592}

# Material categories of the normalizer.
CATEGORIES = (
    ("metals", ["steel", "iron", "copper", "aluminum", "aluminium", "brass", "zinc", "nickel", "lead", "tin", "scrap metal", "ferrous", "non-ferrous", "alloy", "stainless"]),
    ("plastics", ["plastic", "polymer", "pet", "hdpe", "ldpe", "pvc", "pp", "polypropylene", "polyethylene", "polystyrene", "abs"]),
    ("organics", ["organic", "biomass", "food waste", "compost", "agricultural", "wood", "paper", "cardboard", "cellulose"]),
    ("chemicals", ["chemical", "solvent", "acid", "alkali", "caustic", "sulfur", "sulphur", "chlorine", "ammonia"]),
    ("energy", ["steam", "heat", "energy", "power", "electricity", "gas", "fuel", "oil", "coal"]),
    ("water", ["water", "wastewater", "effluent", "sewage", "coolant"]),
    ("construction", ["concrete", "cement", "aggregate", "sand", "gravel", "gypsum", "slag", "fly ash", "ash"]),
)

# Overlapping rules over the words of the driver's materials: first, best and tiered readings differ.
PART_RULES = (
    ("metals", ["bolt", "plate", "rod"]),
    ("plastics", ["ring", "widget"]),
    ("hot goods", ["hot", "red"]),
    ("tools", ["anvil", "gear", "gizmo"]),
)

# Category rules of the backfill.
BACKFILL_CATEGORIES = (
    ("metals", ["zinc", "lead", "copper", "nickel", "aluminum", "aluminium", "iron", "steel", "chromium", "cadmium", "mercury", "arsenic", "metal", "alloy"]),
    ("chemicals", ["acid", "chlor", "sulfur", "sulphur", "nitro", "ammonia", "hydroxide", "oxide", "compound", "solvent", "benzene", "toluene", "xylene", "phenol"]),
    ("organics", ["organic", "carbon", "methane", "ethane", "food", "bio", "sludge"]),
    ("plastics", ["plastic", "polymer", "polyethylene", "polypropylene", "pvc", "styrene"]),
    ("hazardous", ["hazardous", "toxic", "radioactive", "pcb", "dioxin", "furan", "asbestos"]),
    ("water_emissions", ["water", "aqueous", "wastewater", "effluent"]),
    ("air_emissions", ["air", "emission", "particulate", "dust", "pm10", "pm2.5", "nox", "sox"]),
    ("energy", ["oil", "fuel", "petroleum", "coal", "gas"]),
)

# Country keywords to ISO codes, in order.
COUNTRIES = (
    ("DEU", ["germany", "deutschland", "german"]), ("FRA", ["france", "french"]), ("ESP", ["spain", "spanish", "españa"]), ("ITA", ["italy", "italian", "italia"]),
    ("POL", ["poland", "polish", "polska"]), ("NLD", ["netherlands", "dutch", "holland"]), ("BEL", ["belgium", "belgian"]), ("SWE", ["sweden", "swedish"]),
    ("AUT", ["austria", "austrian", "österreich"]), ("CZE", ["czech", "czechia"]), ("ROU", ["romania", "romanian"]), ("PRT", ["portugal", "portuguese"]),
    ("GRC", ["greece", "greek"]), ("HUN", ["hungary", "hungarian"]), ("FIN", ["finland", "finnish"]), ("DNK", ["denmark", "danish"]), ("IRL", ["ireland", "irish"]),
    ("SVK", ["slovakia", "slovak"]), ("BGR", ["bulgaria", "bulgarian"]), ("HRV", ["croatia", "croatian"]), ("SVN", ["slovenia", "slovenian"]),
    ("LTU", ["lithuania", "lithuanian"]), ("LVA", ["latvia", "latvian"]), ("EST", ["estonia", "estonian"]), ("CYP", ["cyprus"]), ("LUX", ["luxembourg"]), ("MLT", ["malta"]),
    ("GBR", ["united kingdom", "uk", "britain", "england", "scotland", "wales"]), ("USA", ["usa", "united states", "america"]),
    ("SAU", ["saudi", "arabia", "riyadh", "jeddah", "jubail"]), ("ARE", ["uae", "emirates", "dubai", "abu dhabi"]), ("QAT", ["qatar", "doha"]), ("KWT", ["kuwait"]),
    ("OMN", ["oman"]), ("BHR", ["bahrain"]), ("EGY", ["egypt", "cairo"]), ("JOR", ["jordan", "amman"]),
)

# Abbreviations that start a material type id.
TYPE_PREFIXES = (("COPPER", "CU"), ("ALUMINUM", "AL"), ("STEEL", "ST"), ("BRASS", "BR"), ("LEAD", "PB"), ("ZINC", "ZN"))

# Category pairs by compatibility; a pair counts in either order.
HIGH_PAIRS = (("organics", "fibers"), ("hydrocarbons", "chemicals"))
MEDIUM_PAIRS = (("plastics", "hydrocarbons"), ("metals", "chemicals"), ("glass", "mixed"))

# Patterns of elements that are noise in a page (C1), in order.
NOISE_ELEMENTS = (
    r"<nav[^>]*>.*?</nav>", r"<header[^>]*>.*?</header>", r"<footer[^>]*>.*?</footer>", r"<aside[^>]*>.*?</aside>", r"<menu[^>]*>.*?</menu>",
    r"<div[^>]*(?:cookie|gdpr|consent|privacy-banner)[^>]*>.*?</div>", r"<div[^>]*class=[\"'][^\"']*(?:cookie|consent|gdpr|banner)[^\"']*[\"'][^>]*>.*?</div>",
    r"<div[^>]*(?:advertisement|ad-container|promo)[^>]*>.*?</div>", r"<!--\s*ad\s*-->.*?<!--\s*/ad\s*-->", r"<div[^>]*(?:social-share|share-buttons)[^>]*>.*?</div>",
    r"<script[^>]*>.*?</script>", r"<style[^>]*>.*?</style>", r"<noscript[^>]*>.*?</noscript>", r"<!--.*?-->",
)

# Patterns of text that is noise (C3), case-insensitive.
NOISE_TEXT = (
    r"(?:we use cookies|this (?:site|website) uses cookies|cookie policy|accept (?:all )?cookies).*?(?:\.|$)",
    r"(?:skip to (?:main )?content|jump to navigation|back to top)",
    r"(?:follow us on|share (?:this|on)|like us on facebook)",
    r"(?:all rights reserved|©\s*\d{4}|privacy policy\s*\|\s*terms)",
)

# Characters with a plain form.
PLAIN_CHARS = (("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"), ("…", "..."), (" ", " "))

# Keywords of fact schemas, in the order they are tried.
FACT_SCHEMAS = (("carbon_emission", ["co2", "carbon", "emission", "ghg", "greenhouse"]), ("symbiosis_exchange", ["symbiosis", "exchange", "industrial park", "eco-park"]))
FACT_MATERIALS = ("steel", "iron", "copper", "aluminum", "plastic", "paper", "slag", "fly ash")
ECO_PARKS = ("kalundborg", "ulsan", "tianjin", "kawasaki")

# Volume tiers (tons a year), regional price modifiers, and one industry's waste profile (material, percent).
TIERS = {"small": 500, "medium": 5000, "large": 50000, "enterprise": 200000}
REGIONS = {"north_america": 1.00, "europe": 1.15, "mena": 0.85, "asia_pacific": 0.95, "latin_america": 0.75, "africa": 0.65}
AUTOMOTIVE = (("scrap_steel", 45), ("scrap_aluminum", 20), ("mixed_plastics", 15), ("used_oil", 12), ("scrap_tires", 8))

# Reference prices of materials: low, high (USD a ton), CO2 factor.
REFERENCE_PRICES = (
    ("scrap_steel", 150, 350, 1.74), ("scrap_aluminum", 800, 1800, 9.7), ("scrap_copper", 4000, 8000, 2.6), ("mixed_metals", 100, 400, 3.0), ("precious_metals", 10000, 50000, 12.0),
    ("pet_plastic", 200, 500, 2.0), ("hdpe_plastic", 250, 600, 1.9), ("mixed_plastics", 50, 200, 2.2), ("pvc_plastic", 100, 300, 2.4),
    ("corrugated_cardboard", 80, 200, 0.9), ("mixed_paper", 40, 120, 0.8), ("office_paper", 100, 250, 0.7), ("clear_glass", 30, 80, 0.5), ("mixed_glass", 15, 50, 0.4),
    ("food_waste", -20, 50, 0.4), ("yard_waste", -10, 30, 0.2), ("agricultural_waste", -15, 40, 0.3), ("concrete_rubble", -5, 15, 0.1), ("wood_waste", 10, 60, 0.3), ("asphalt", 5, 30, 0.15), ("gypsum", -10, 20, 0.1),
    ("fly_ash", 5, 50, 0.1), ("slag", 10, 40, 0.2), ("used_oil", 50, 200, 2.5), ("solvents", 100, 500, 2.0), ("spent_catalysts", 500, 5000, 8.0),
    ("tailings", 5, 25, 0.1), ("waste_rock", 2, 15, 0.05), ("mining_chemicals", 50, 300, 1.5), ("drilling_waste", -50, 20, 0.5), ("produced_water", -30, 10, 0.2), ("tank_bottoms", -20, 100, 1.0),
    ("e_waste", 200, 2000, 20.0), ("circuit_boards", 3000, 15000, 25.0), ("batteries", 100, 1000, 5.0), ("textile_waste", 50, 300, 1.5), ("fiber_waste", 100, 500, 1.2),
    ("medical_waste", -500, -100, 3.0), ("pharmaceutical_waste", -300, 50, 2.0), ("scrap_tires", -50, 100, 2.8), ("rubber_waste", 50, 200, 2.5),
)

# Patterns of report facts (E12 to E16), case-insensitive, in order.
WASTE_PATTERNS = (
    r"(recycled?|disposed?|generated?|diverted?|recovered?)\s+([\d,]+(?:\.\d+)?)\s*(tonnes?|tons?|mt|kg)\s+(?:of\s+)?([a-zA-Z\s]+)",
    r"([a-zA-Z]+\s*waste)\s*[:=]\s*([\d,]+(?:\.\d+)?)\s*(tonnes?|tons?|mt)",
    r"([\d,]+(?:\.\d+)?)\s*(tonnes?|tons?|mt)\s+(?:of\s+)?([a-zA-Z\s]+)\s+(recycled?|disposed?|generated?)",
    r"total\s+waste\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(tonnes?|tons?|mt)",
    r"waste\s+(?:to\s+)?landfill\s*[\|:]\s*([\d,]+(?:\.\d+)?)",
    r"hazardous\s+waste\s*[\|:]\s*([\d,]+(?:\.\d+)?)",
    r"(plastic|paper|metal|glass|organic)\s+waste\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(tonnes?|tons?)?",
)
EMISSION_PATTERNS = (
    r"(CO2|CO₂|carbon\s*dioxide|GHG|greenhouse\s*gas)\s*(?:emissions?)?\s*[:=]?\s*([\d,.]+)\s*(million)?\s*(tonnes?|tons?|mt|tCO2e?)",
    r"(Scope\s*[123])\s*(?:emissions?)?\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(tonnes?|tCO2e?|mt|kt)",
    r"reduced?\s+(?:emissions?|CO2|carbon)\s+(?:by\s+)?([\d,.]+)\s*(%|percent|tonnes?)",
    r"carbon\s+footprint\s*(?:of|:)?\s*([\d,.]+)\s*(million)?\s*(tonnes?|tons?|tCO2)?",
    r"(methane|CH4|NOx|SOx)\s*(?:emissions?)?\s*[:=]?\s*([\d,.]+)\s*(tonnes?|mt|kg)",
)
ENERGY_PATTERNS = (
    r"(?:energy|electricity)\s+(?:consumption|usage)\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(MWh|GWh|TWh|GJ|TJ)",
    r"(?:saved?|reduced?)\s+([\d,]+(?:\.\d+)?)\s*(MWh|GWh|kWh|GJ)\s+(?:of\s+)?(?:energy|electricity)?",
    r"([\d,]+(?:\.\d+)?)\s*(MWh|GWh|TWh|GJ|TJ)\s+(?:of\s+)?(?:renewable|clean|green)\s+energy",
    r"renewable\s+energy\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(%|percent|MWh|GWh)?",
    r"solar\s+(?:capacity|generation)\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(MW|GW|MWh)?",
)
FINANCIAL_PATTERNS = (
    r"\$\s*([\d,.]+)\s*(million|billion|M|B)?\s+(?:in\s+)?(?:savings?|saved)",
    r"\$\s*([\d,.]+)\s*(million|billion|M|B)?\s+(?:in\s+)?(?:revenue|income)",
    r"\$\s*([\d,.]+)\s*(million|billion|M|B)?\s+(?:in\s+)?(?:investment|invested)",
    r"\$\s*([\d,.]+)\s*(million|billion|M|B)?\s+(?:in\s+)?(?:cost|expense)",
    r"(?:cost|expense)\s+(?:savings?|reduction)\s*[:=]?\s*\$\s*([\d,.]+)\s*(million|M)?",
    r"(?:recycling|environmental)\s+revenue\s*[:=]?\s*\$?\s*([\d,.]+)\s*(million|M)?",
    r"(?:USD|EUR|€)\s*([\d,.]+)\s*(million|billion|M|B)?",
    r"\$\s*([\d,.]+)\s*(?:per|/)\s*(?:ton|tonne|mt)",
)
CARBON_CREDIT_PATTERNS = (
    r"(?:purchased?|bought|acquired?)\s+([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:carbon)?\s*(?:credits?|offsets?|allowances?)",
    r"([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:carbon)?\s*(?:credits?|offsets?)\s+(?:purchased?|bought|acquired?)",
    r"offset\s+([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:tonnes?|tons?|tCO2e?)\s+(?:of\s+)?(?:CO2|carbon|emissions?)?",
    r"([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:tonnes?|tCO2e?)\s+(?:of\s+)?(?:carbon|CO2)\s+offset",
    r"\$\s*([\d,.]+)\s*(million|billion|M|B)?\s+(?:on|for|spent\s+on)?\s*(?:carbon)?\s*(?:credits?|offsets?)",
    r"(?:carbon|offset)\s+(?:spend|spending|expenditure|cost)\s*[:=]?\s*\$?\s*([\d,.]+)\s*(million|M)?",
    r"(?:invested?|spent?)\s+\$?\s*([\d,.]+)\s*(million|M)?\s+(?:in|on)\s+(?:carbon)?\s*(?:credits?|offsets?)",
    r"(?:carbon|CO2)\s+price\s*(?:of|[:=])?\s*(?:\$|€|EUR|USD)?\s*([\d,.]+)\s*(?:per|/)\s*(?:tonne?|ton|tCO2e?)",
    r"(?:\$|€)\s*([\d,.]+)\s*(?:per|/)\s*(?:tonne?|ton)?\s*(?:of\s+)?(?:carbon|CO2)",
    r"(?:EUA|ETS|EU\s*allowances?)\s*[:=]?\s*([\d,]+(?:\.\d+)?)\s*(?:million)?",
    r"(?:retired?|surrendered?)\s+([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:EUA|allowances?)",
    r"(?:carbon|emissions?)\s+trading\s+(?:revenue|income)\s*[:=]?\s*\$?\s*([\d,.]+)\s*(million|M)?",
    r"(?:sold|selling)\s+([\d,]+(?:\.\d+)?)\s*(?:million)?\s*(?:carbon)?\s*(?:credits?|allowances?)",
    r"(?:VCS|Verra|Gold\s*Standard)\s+(?:credits?|offsets?)\s*[:=]?\s*([\d,]+(?:\.\d+)?)",
    r"(?:carbon\s*neutral|net\s*zero)\s+(?:by|target|goal)\s+(20\d{2})",
)
