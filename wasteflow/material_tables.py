"""Rule tables that map materials to price types, material profiles, and receivers. Order counts."""

# Keyword, price type, confidence; the highest confidence counts, the first one at ties.
BEST_RULES = (
    ("copper", "CU-BAREBRGHT", 0.95), ("cu ", "CU-BAREBRGHT", 0.90), ("cupric", "CU-BAREBRGHT", 0.85),
    ("aluminum", "AL-6063", 0.95), ("aluminium", "AL-6063", 0.95), ("al scrap", "AL-6063", 0.90), ("bauxite", "AL-6063", 0.70),
    ("steel", "ST-HMS1", 0.95), ("iron", "ST-HMS1", 0.90), ("ferrous", "ST-HMS1", 0.85), ("stainless", "ST-HMS1", 0.85), ("cast iron", "ST-HMS1", 0.85), ("hms", "ST-HMS1", 0.95), ("scrap metal", "ST-HMS1", 0.80),
    ("brass", "BR-YELLOW", 0.95), ("bronze", "BR-YELLOW", 0.90),
    ("lead", "PB-SOLID", 0.95), ("pb ", "PB-SOLID", 0.85), ("battery", "PB-BATTERIES", 0.80), ("batteries", "PB-BATTERIES", 0.85),
    ("zinc", "ST-HMS1", 0.75), ("zn ", "ST-HMS1", 0.70), ("nickel", "ST-HMS1", 0.75), ("ni ", "ST-HMS1", 0.70),
    ("tin", "ST-HMS1", 0.70), ("titanium", "AL-6063", 0.65), ("magnesium", "AL-6063", 0.65), ("precious metal", "CU-BAREBRGHT", 0.50),
    ("plastic", "AL-UBC", 0.60), ("polymer", "AL-UBC", 0.60), ("hdpe", "AL-UBC", 0.65), ("ldpe", "AL-UBC", 0.65), ("pet", "AL-UBC", 0.65), ("pvc", "AL-UBC", 0.60), ("polypropylene", "AL-UBC", 0.65), ("polyethylene", "AL-UBC", 0.65), ("polystyrene", "AL-UBC", 0.60), ("nylon", "AL-UBC", 0.60), ("abs", "AL-UBC", 0.60),
    ("paper", "ST-HMS1", 0.50), ("cardboard", "ST-HMS1", 0.50), ("carton", "ST-HMS1", 0.50), ("pulp", "ST-HMS1", 0.45),
    ("glass", "ST-HMS1", 0.50), ("cullet", "ST-HMS1", 0.55),
    ("electronic", "CU-BAREBRGHT", 0.60), ("pcb", "CU-BAREBRGHT", 0.65), ("circuit", "CU-BAREBRGHT", 0.60), ("cable", "CU-WIRE1", 0.70), ("wire", "CU-WIRE1", 0.70), ("computer", "CU-BAREBRGHT", 0.55),
    ("rubber", "ST-HMS1", 0.45), ("tire", "ST-HMS1", 0.45), ("tyre", "ST-HMS1", 0.45),
    ("concrete", "ST-HMS1", 0.40), ("cement", "ST-HMS1", 0.40), ("brick", "ST-HMS1", 0.40), ("asphalt", "ST-HMS1", 0.40), ("demolition", "ST-HMS1", 0.35), ("construction", "ST-HMS1", 0.35),
    ("organic", "ST-HMS1", 0.30), ("biomass", "ST-HMS1", 0.35), ("wood", "ST-HMS1", 0.40), ("timber", "ST-HMS1", 0.45), ("food", "ST-HMS1", 0.25), ("compost", "ST-HMS1", 0.25),
    ("solvent", "ST-HMS1", 0.50), ("acid", "ST-HMS1", 0.45), ("chemical", "ST-HMS1", 0.40), ("oil", "AL-6063", 0.55), ("lubricant", "AL-6063", 0.50), ("petroleum", "AL-6063", 0.50),
    ("textile", "ST-HMS1", 0.40), ("fabric", "ST-HMS1", 0.40), ("cotton", "ST-HMS1", 0.45), ("leather", "ST-HMS1", 0.50),
    ("waste", "ST-HMS1", 0.30), ("scrap", "ST-HMS1", 0.35), ("residue", "ST-HMS1", 0.25), ("sludge", "ST-HMS1", 0.20), ("ash", "ST-HMS1", 0.20),
)

# Price type and its keywords, tier by tier; the first keyword found counts.
SPECIFIC_RULES = (
    ("CU-BAREBRGHT", ["copper"]), ("AL-6063", ["aluminum", "aluminium"]), ("ST-HMS1", ["steel", "iron"]), ("BR-YELLOW", ["brass"]), ("PB-SOLID", ["lead"]), ("PB-BATTERIES", ["battery"]), ("ST-HMS1", ["zinc"]),
    ("PLASTIC-MIXED", ["plastic", "polymer", "hdpe", "pvc", "pet"]), ("PAPER-MIXED", ["paper", "cardboard"]), ("CU-BAREBRGHT", ["electronic"]), ("CU-WIRE1", ["cable", "wire"]),
    ("ORGANIC", ["organic", "biomass", "wood", "food"]), ("CONSTRUCTION", ["concrete", "cement", "demolition"]),
)
CATEGORY_RULES = (("CHEM-HAZ", ["hazardous"]), ("CHEM-NONHAZ", ["non-hazardous", "nonhazardous"]), ("CHEM-HAZ", ["toxic", "solvent", "acid", "chlor", "fluor"]), ("CHEM-NONHAZ", ["oxide", "sulfate", "oil"]))
TIERED_RULES = ((SPECIFIC_RULES, 0.8), (CATEGORY_RULES, 0.6), ("CHEM-NONHAZ", 0.4))

# Default price type, name, USD a ton.
DEFAULT_PRICES = (
    ("CHEM-HAZ", "Hazardous Chemicals", 150), ("CHEM-NONHAZ", "Non-Hazardous Chemicals", 80), ("METAL-MIXED", "Mixed Metals", 320), ("PLASTIC-MIXED", "Mixed Plastics", 200),
    ("PAPER-MIXED", "Mixed Paper", 80), ("ORGANIC", "Organic Waste", 50), ("CONSTRUCTION", "Construction Waste", 30), ("OTHER", "Other Industrial", 50),
)

# Category and its keywords; the first keyword found counts.
SMART_RULES = (
    ("COPPER", ["copper"]), ("ALUMINUM", ["aluminum", "aluminium"]), ("STEEL", ["steel"]), ("IRON", ["iron"]), ("BRASS", ["brass"]), ("LEAD", ["lead"]), ("ZINC", ["zinc"]), ("NICKEL", ["nickel"]), ("STAINLESS", ["stainless"]),
    ("PLASTICS", ["plastic", "polymer", "hdpe", "ldpe", "pet", "pvc", "polypropylene", "polyethylene", "polystyrene"]), ("PAPER", ["paper", "cardboard", "carton"]), ("GLASS", ["glass"]), ("ORGANICS", ["organic", "biomass", "wood", "timber", "food"]),
    ("CONSTRUCTION", ["concrete", "cement", "brick", "demolition", "asphalt"]), ("ELECTRONICS", ["electronic", "battery", "circuit", "cable", "wire"]), ("TEXTILES", ["textile", "fabric", "cotton", "leather"]), ("RUBBER", ["rubber", "tire", "tyre"]),
    ("PETROLEUM", ["oil", "petroleum", "fuel", "lubricant"]), ("SOLVENTS", ["solvent", "methanol", "ethanol", "acetone", "toluene"]), ("ACIDS", ["acid", "sulfuric", "hydrochloric", "phosphoric", "nitric"]), ("BASES", ["hydroxide", "ammonia", "caustic"]),
    ("CHLORINATED", ["chlor"]), ("FLUORINATED", ["fluor"]), ("OXIDES-SALTS", ["oxide", "sulfate", "nitrate", "carbonate"]), ("HAZ-WASTE-GENERAL", ["hazardous waste"]), ("NONHAZ-WASTE", ["non-hazardous", "nonhazardous"]),
    ("MIXED-WASTE", ["waste"]), ("SLUDGE", ["sludge"]), ("ASH", ["ash"]), ("RESIDUE", ["residue"]),
)

# Category, USD a ton.
CATEGORY_PRICES = (
    ("COPPER", 10800), ("ALUMINUM", 2000), ("STEEL", 320), ("IRON", 280), ("BRASS", 6500), ("LEAD", 1500), ("ZINC", 900), ("NICKEL", 12000), ("STAINLESS", 1000), ("PLASTICS", 1100), ("PAPER", 100), ("GLASS", 50), ("ORGANICS", 30), ("CONSTRUCTION", 25), ("ELECTRONICS", 3000), ("TEXTILES", 200),
    ("RUBBER", 150), ("PETROLEUM", 400), ("SOLVENTS", 600), ("ACIDS", 200), ("BASES", 300), ("CHLORINATED", 300), ("FLUORINATED", 500), ("OXIDES-SALTS", 150), ("HAZ-WASTE-GENERAL", 150), ("NONHAZ-WASTE", 80), ("MIXED-WASTE", 50), ("SLUDGE", 30), ("ASH", 20), ("RESIDUE", 25), ("UNCLASSIFIED", 40),
)

# Material keyword; components with their shares, hazards, uses. The first keyword found counts.
CHEMICAL_PROFILES = (
    ("sludge", (("Water", "40-80%"), ("Organic Solids", "10-40%"), ("Inorganic Solids (Sand/Grit)", "5-20%"), ("Heavy Metals (Zn, Cu, Pb)", "<1%")), ("Biological", "Heavy Metal Toxicity"), ("Biogas Generation", "Fertilizer", "Construction Filler")),
    ("non-hazardous waste", (("Mixed Paper/Cardboard", "20-40%"), ("Plastics (Mixed)", "10-30%"), ("Organics/Food", "20-30%"), ("Inert Glass/Metal", "10-20%")), ("Low",), ("RDF Fuel", "Recycling Sorting", "Compost")),
    ("hazardous waste", (("Solvents", "10-50%"), ("Heavy Metals (Hg, Pb, Cd)", "1-10%"), ("Oily Sludge", "20-40%"), ("Acids/Bases", "5-15%")), ("Toxic", "Flammable", "Corrosive"), ("Solvent Recovery", "Metal Extraction", "Incineration")),
    ("fly ash", (("Silicon Dioxide (SiO2)", "40-60%"), ("Aluminum Oxide (Al2O3)", "20-30%"), ("Iron Oxide (Fe2O3)", "5-10%"), ("Calcium Oxide (CaO)", "1-5%")), ("Inhalation (Silica)", "Heavy Metal Leaching"), ("Concrete Additive", "Geopolymer Cement", "Road Base")),
    ("spent catalyst", (("Aluminum Oxide Support", "80-90%"), ("Nickel/Cobalt/Molybdenum", "5-15%"), ("Sulfur/Carbon Deposits", "1-5%")), ("Flammability", "Carcinogenic Metals"), ("Metal Recovery", "Abrasives")),
    ("red mud", (("Iron Oxide (Fe2O3)", "30-60%"), ("Aluminum Oxide (Al2O3)", "10-20%"), ("Silicon Dioxide (SiO2)", "3-10%"), ("Titanium Dioxide (TiO2)", "2-10%"), ("Sodium Oxide (Na2O)", "2-10%")), ("High Alkalinity (pH > 10)",), ("Iron Recovery", "Building Materials", "Pigments")),
    ("drilling mud", (("Barite", "30-50%"), ("Bentonite Clay", "10-30%"), ("Water/Oil Emulsion", "20-40%"), ("Polymers", "1-5%")), ("Hydrocarbon Contamination",), ("Road Stabilization", "Landfill Cover")),
    ("tailings", (("Silicates", "60-80%"), ("Sulfides (Pyrite)", "5-20%"), ("Trace Metals", "0.1-2%")), ("Acid Mine Drainage", "Heavy Metal Leaching"), ("Backfill", "Brick Manufacturing", "Glass Making")),
)

# Receiver type, the word of the category, the word of the material; the first that holds counts.
RECEIVER_TYPES = (
    ("Composting Facility or Biogas Plant", "organic", "food"), ("Metal Smelter or Foundry", "metal", "zinc"), ("Plastic Reprocessor", "plastic", "polymer"), ("Hazardous Waste Incinerator", "hazardous", "toxic"),
)
OTHER_RECEIVER = "Recycling Facility"

# Category, receivers, carbon offset; and what other categories have.
RECEIVERS = (
    ("plastics", ("recyclers", "injection molding", "3D printing", "construction materials"), "2.5 tons CO2/ton recycled"),
    ("metals", ("foundries", "manufacturing", "electronics", "construction"), "4.0 tons CO2/ton recycled"),
    ("organics", ("composting", "anaerobic digestion", "animal feed", "biogas plants"), "0.5 tons CO2/ton composted"),
    ("chemicals", ("chemical processing", "water treatment", "industrial cleaning"), "1.0 tons CO2/ton recovered"),
    ("hydrocarbons", ("refineries", "energy recovery", "fuel blending"), "3.0 tons CO2/ton recovered"),
    ("fibers", ("paper mills", "cardboard manufacturing", "insulation"), "1.5 tons CO2/ton recycled"),
    ("glass", ("glass manufacturing", "construction aggregate", "insulation"), "0.3 tons CO2/ton recycled"),
    ("hazardous", ("specialized treatment", "cement kilns", "incineration"), "0.2 tons CO2/ton treated"),
    ("mixed", ("material recovery facilities", "waste-to-energy"), "1.0 tons CO2/ton processed"),
)
OTHER_RECEIVERS = (("general recycling",), "1.0 tons CO2/ton")

# Industry and its waste categories; others have mixed waste.
INDUSTRY_CATEGORIES = (
    ("food processing", ("organics", "plastics", "fibers")), ("automotive manufacturing", ("metals", "plastics", "chemicals")), ("chemical production", ("chemicals", "hydrocarbons", "hazardous")),
    ("textile manufacturing", ("fibers", "chemicals", "plastics")), ("electronics assembly", ("metals", "plastics", "hazardous")), ("construction", ("mixed", "metals", "fibers", "glass")),
)
