"""Fixed values.

Word lists, patterns, region tables and limits that results depend on. They are given here as
plain text so that results stay comparable; code elsewhere only refers to them.
"""

# --- fixed values: coordinate validity boxes (south, west, north, east) -------------------------
US_BOX = (24.0, -180.0, 72.0, -65.0)
US_WIDE_BOX = (18.0, -180.0, 72.0, -65.0)
CA_BOX = (41.0, -141.0, 84.0, -52.0)

# --- fixed values: state boxes (code, south, west, north, east), in match order -----------------
STATE_BOXES = [
    ("AL", 30.14, -88.52, 35.01, -84.89),
    ("AK", 51.0, -179.5, 71.5, -129.0),
    ("AZ", 31.33, -114.82, 37.0, -109.04),
    ("AR", 33.0, -94.62, 36.5, -89.64),
    ("CA", 32.53, -124.48, 42.01, -114.13),
    ("CO", 36.99, -109.06, 41.0, -102.04),
    ("CT", 40.98, -73.73, 42.05, -71.79),
    ("DE", 38.45, -75.79, 39.84, -75.05),
    ("DC", 38.79, -77.12, 38.99, -76.91),
    ("FL", 24.52, -87.63, 31.0, -80.03),
    ("GA", 30.36, -85.61, 35.0, -80.84),
    ("HI", 18.91, -160.28, 22.24, -154.81),
    ("ID", 41.99, -117.24, 49.0, -111.04),
    ("IL", 36.97, -91.51, 42.51, -87.02),
    ("IN", 37.77, -88.1, 41.76, -84.78),
    ("IA", 40.38, -96.64, 43.5, -90.14),
    ("KS", 36.99, -102.05, 40.0, -94.59),
    ("KY", 36.5, -89.57, 39.15, -81.96),
    ("LA", 28.93, -94.04, 33.02, -88.82),
    ("ME", 43.06, -71.08, 47.46, -66.95),
    ("MD", 37.91, -79.49, 39.72, -75.05),
    ("MA", 41.24, -73.5, 42.89, -69.93),
    ("MI", 41.7, -90.42, 48.3, -82.41),
    ("MN", 43.5, -97.24, 49.38, -89.49),
    ("MS", 30.17, -91.66, 35.0, -88.1),
    ("MO", 35.99, -95.77, 40.61, -89.1),
    ("MT", 44.36, -116.05, 49.0, -104.04),
    ("NE", 39.99, -104.05, 43.0, -95.31),
    ("NV", 35.0, -120.01, 42.0, -114.04),
    ("NH", 42.7, -72.56, 45.31, -70.7),
    ("NJ", 38.93, -75.56, 41.36, -73.89),
    ("NM", 31.33, -109.05, 37.0, -103.0),
    ("NY", 40.5, -79.76, 45.02, -71.86),
    ("NC", 33.84, -84.32, 36.59, -75.46),
    ("ND", 45.94, -104.05, 49.0, -96.55),
    ("OH", 38.4, -84.82, 42.33, -80.52),
    ("OK", 33.62, -103.0, 37.0, -94.43),
    ("OR", 41.99, -124.57, 46.29, -116.46),
    ("PA", 39.72, -80.52, 42.27, -74.69),
    ("RI", 41.15, -71.86, 42.02, -71.12),
    ("SC", 32.03, -83.35, 35.22, -78.54),
    ("SD", 42.48, -104.06, 45.94, -96.44),
    ("TN", 34.98, -90.31, 36.68, -81.65),
    ("TX", 25.84, -106.65, 36.5, -93.51),
    ("UT", 36.99, -114.05, 42.12, -109.04),
    ("VT", 42.73, -73.44, 45.02, -71.46),
    ("VA", 36.54, -83.68, 39.47, -75.24),
    ("WA", 45.54, -124.85, 49.0, -116.92),
    ("WV", 37.2, -82.64, 40.64, -77.72),
    ("WI", 42.49, -92.89, 47.08, -86.25),
    ("WY", 40.99, -111.06, 45.01, -104.05),
]
# (code a, code b, meridian, code east of it, code west of it)
STATE_OVERLAPS = [
    ("ID", "MT", -116.050694, "MT", "ID"),
    ("ID", "WY", -111.05, "WY", "ID"),
    ("MT", "WY", -104.05, "MT", "WY"),
]
PROVINCE_BOXES = [
    ("AB", 49.0, -120.0, 60.0, -110.0),
    ("BC", 48.3, -139.0, 60.0, -114.0),
    ("MB", 49.0, -102.0, 60.0, -88.5),
    ("NB", 44.5, -69.0, 48.0, -63.5),
    ("NL", 46.0, -67.0, 60.5, -52.0),
    ("NS", 43.5, -66.5, 47.0, -59.5),
    ("NT", 60.0, -136.0, 78.0, -102.0),
    ("NU", 51.0, -120.0, 84.0, -61.0),
    ("ON", 41.5, -95.5, 57.0, -74.0),
    ("PE", 45.9, -64.5, 47.1, -61.8),
    ("QC", 45.0, -80.0, 63.0, -57.0),
    ("SK", 49.0, -110.5, 60.5, -101.0),
    ("YT", 60.0, -141.0, 69.5, -128.0),
]
# large provinces are read in sub-boxes (code, part, south, west, north, east)
PROVINCE_PARTS = [
    ("AB", 1, 49.0, -120.0, 54.0, -114.0),
    ("AB", 2, 49.0, -114.0, 54.0, -110.0),
    ("AB", 3, 54.0, -120.0, 60.0, -114.0),
    ("AB", 4, 54.0, -114.0, 60.0, -110.0),
    ("BC", 1, 48.3, -139.0, 52.0, -125.0),
    ("BC", 2, 48.3, -125.0, 52.0, -114.0),
    ("BC", 3, 52.0, -139.0, 56.0, -125.0),
    ("BC", 4, 52.0, -125.0, 56.0, -114.0),
    ("BC", 5, 56.0, -132.0, 60.0, -114.0),
    ("ON", 1, 41.5, -95.5, 49.0, -84.0),
    ("ON", 2, 41.5, -84.0, 49.0, -74.0),
    ("ON", 3, 49.0, -95.5, 57.0, -84.0),
    ("ON", 4, 49.0, -84.0, 57.0, -74.0),
    ("QC", 1, 45.0, -80.0, 52.0, -70.0),
    ("QC", 2, 45.0, -70.0, 52.0, -57.0),
    ("QC", 3, 52.0, -80.0, 63.0, -70.0),
    ("QC", 4, 52.0, -70.0, 63.0, -57.0),
]
STATE_CENTRES = [
    ("AL", 32.8, -86.8),
    ("AK", 64.2, -152.5),
    ("AZ", 34.3, -111.7),
    ("AR", 34.8, -92.2),
    ("CA", 37.2, -119.5),
    ("CO", 39.0, -105.5),
    ("CT", 41.6, -72.7),
    ("DE", 39.0, -75.5),
    ("DC", 38.9, -77.0),
    ("FL", 28.6, -82.4),
    ("GA", 32.7, -83.4),
    ("HI", 20.8, -156.3),
    ("ID", 44.4, -114.6),
    ("IL", 40.0, -89.2),
    ("IN", 39.9, -86.3),
    ("IA", 42.0, -93.5),
    ("KS", 38.5, -98.4),
    ("KY", 37.8, -85.7),
    ("LA", 31.0, -92.0),
    ("ME", 45.4, -69.2),
    ("MD", 39.0, -76.8),
    ("MA", 42.3, -71.8),
    ("MI", 44.3, -85.4),
    ("MN", 46.3, -94.3),
    ("MS", 32.7, -89.7),
    ("MO", 38.4, -92.5),
    ("MT", 47.0, -109.6),
    ("NE", 41.5, -99.8),
    ("NV", 39.3, -116.6),
    ("NH", 43.7, -71.6),
    ("NJ", 40.1, -74.7),
    ("NM", 34.4, -106.1),
    ("NY", 42.9, -75.5),
    ("NC", 35.5, -79.4),
    ("ND", 47.5, -100.5),
    ("OH", 40.4, -82.8),
    ("OK", 35.6, -97.5),
    ("OR", 44.0, -120.5),
    ("PA", 40.9, -77.8),
    ("RI", 41.7, -71.5),
    ("SC", 33.9, -80.9),
    ("SD", 44.4, -100.2),
    ("TN", 35.8, -86.3),
    ("TX", 31.5, -99.4),
    ("UT", 39.3, -111.7),
    ("VT", 44.1, -72.7),
    ("VA", 37.5, -78.7),
    ("WA", 47.4, -120.5),
    ("WV", 38.9, -80.5),
    ("WI", 44.6, -89.8),
    ("WY", 43.0, -107.5),
    ("PR", 18.2, -66.5),
    ("VI", 18.3, -64.8),
    ("GU", 13.4, 144.7),
    ("AS", -14.3, -170.7),
    ("MP", 15.2, 145.7),
]
# states whose road tables may answer for a state without one
ROAD_FALLBACK_STATES = {
    "ID": ["MT", "WA", "OR", "NV", "UT", "WY"],
    "MT": ["ID", "WY", "ND", "SD"],
    "WA": ["ID", "OR", "MT"],
    "OR": ["ID", "WA", "CA", "NV"],
    "WY": ["ID", "MT", "CO", "UT", "SD", "NE"],
    "ND": ["MT", "SD", "MN"],
    "SD": ["MT", "ND", "WY", "NE"],
    "NV": ["ID", "CA", "OR", "UT", "AZ"],
    "UT": ["ID", "NV", "AZ", "CO", "WY"],
    "CO": ["WY", "UT", "NM", "OK", "KS", "NE"],
}

# --- fixed values: distances ---------------------------------------------------------------------
DEDUPE_MI = 0.12
SAME_MANAGER_MI = 0.05
OFFICIAL_MATCH_MI = 0.5
HIGHWAY_PAIR_MI = 0.45
CAMPGROUND_MERGE_MI = 0.35
MICRO_CLUSTER_M = 80.0
MICRO_CLUSTER_MEMBERS = 3
PARK_MERGE_M = 500.0
AMENITY_NAME_M = 80.0
AMENITY_SUBTYPE_M = 25.0
ACCESS_MAX_M = 120.0
ACCESS_TIE_M = 30.0
SCENIC_MEASURE_M = 250.0
SCENIC_LEAN_M = 135.0
ROAD_DEFAULT_M = 800.0
ROAD_QA_M = 1200.0
#: distance of a site whose state has a table but no road or trail in reach
REMOTE_M = 999999.0
VC_MATCH_M = 400.0
VC_MISMATCH_M = 200.0
VC_OSM_RADIUS_M = 350.0
VC_OSM_FAR_M = 150.0
UNIT_FALLBACK_M = 80000.0
PIN_CLUSTER_KM = 3.0
PIN_LABEL_KM = 80.0
MIN_RING_AREA_DEG2 = 0.000003
MIN_RING_AREA_RATIO = 0.018

# --- fixed values: map tags ----------------------------------------------------------------------
HISTORIC_EXCLUDED = [
    "boundary_stone", "milestone", "wayside_cross", "survey_point", "boundstone", "stone",
    "cattle_grid", "power_pole",
]
GENERIC_POI_NAMES = [
    "playground", "scenic viewpoint", "viewpoint", "historic site", "historic building", "historic",
    "ruins", "memorial", "monument",
]
POI_KINDS = {
    "playground": ("PG", "Playground"),
    "viewpoint": ("SV", "Scenic viewpoint"),
    "historic": ("HL", "Historic site"),
}
FUEL_TAG_KEYS = [
    "name", "brand", "operator", "addr:housename", "amenity", "shop", "highway", "fuel:diesel",
    "diesel", "ref", "exit", "toilets",
]
LEAN_HIGHWAYS = [
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary",
    "secondary_link", "tertiary", "tertiary_link",
]
WIDE_HIGHWAYS = [
    *LEAN_HIGHWAYS, "unclassified", "residential", "living_street", "service", "road",
]
NON_DRIVABLE_HIGHWAYS = [
    "footway", "path", "cycleway", "bridleway", "pedestrian", "steps", "corridor", "platform",
    "proposed", "construction", "elevator", "escape", "raceway",
]
PATH_HIGHWAYS = ["footway", "path", "cycleway", "bridleway", "pedestrian", "steps", "track"]

# --- fixed values: fuel --------------------------------------------------------------------------
TRAVEL_PLAZA = "travel_plaza"
CONVENIENCE_FUEL = "convenience_fuel"
LEGACY_TRAVEL_TYPES = ["travel_center", "highway_service_centre"]
SISTER_BRANDS = ("pilot", "flyingj")
SISTER_MERGED = "pilot_flyingj"
INFORMATIONAL_FLAGS = ["PILOT_FJ_CLUSTER", "SUPPLEMENT", "ONROUTE_HWY_PAIR"]
CONFLICTING_RETAIL = [
    "esso", "petro canada", "petrocanada", "shell", "chevron", "mobil", "exxon", "hess", "sunoco",
    "marathon", "speedway", "circle k", "7 eleven", "costco", "safeway", "husky", "ultramar",
    "texaco", "valero", "phillips", "conoco", "marina", "76", "co op", "petro",
]
TRAVEL_STOP_PINS = ["travelstoppin.png", "travelstop2.png"]
NON_FUEL_PINS = ["speedcopin.png"]

# decision tables: (outcome, ways), a way is a list of (field, test, words); the first rule that holds decides
PLAZA_NAME = [[("name", "has", ["onroute", "on route"])], [("blob", "has", ["onroute"])]]
# plain retail brands in Canada that are no fuel stop of a chain
CA_BRANDS_REFUSED = [
    [("brand", "has", ["petro canada", "petrocanada"]), ("blob", "unlike", [r"petro\s*pass|petropass|petro-pass"])],
    [("name", "is", ["petro canada", "petrocanada"]), ("blob", "unlike", [r"petro\s*pass|petropass|petro-pass"])],
    [("name", "is", ["husky"]), ("blob", "lacks", ["travel", "truck"])],
    [("brand", "is", ["husky"]), ("name", "lacks", ["esso"]), ("blob", "lacks", ["travel", "truck"])],
    [("brand", "is", ["husky"]), ("name", "has", ["husky"]), ("blob", "lacks", ["travel", "truck"])],
    [("brand", "has", ["irving"]), ("blob", "lacks", ["big stop"])],
    [("name", "has", ["irving"]), ("blob", "lacks", ["big stop"])],
]
CA_BRAND_RULES = [
    (
        "petro_pass",
        [
            [("blob", "like", [r"petro[\s-]*pass|petropass"])],
            [("brand", "tagged", ["Petro-Pass", "Petro Pass", "PetroPass"])],
        ],
    ),
    ("onroute", PLAZA_NAME),
    (
        "irving_bigstop",
        [
            [("blob", "has", ["big stop"]), ("blob", "has", ["irving"])],
            [("blob", "has", ["big stop"]), ("brand", "has", ["irving"])],
            [("blob", "has", ["big stop"]), ("name", "has", ["irving", "big stop"])],
            [("blob", "has", ["big stop"]), ("brand", "tagged", ["Irving Big Stop", "Big Stop"])],
        ],
    ),
    (
        "husky_travel",
        [
            [("blob", "has", ["husky travel", "husky truck"])],
            [("brand", "tagged", ["Husky Travel Center", "Husky Travel Centre"])],
            [("name", "listed", ["husky_travel"])],
        ],
    ),
]
# tried after the sister brands, each only where the catalogue lists it
CA_CONVENIENCE_RULES = [
    (
        "couche_tard",
        [[("brand", "tagged", ["Couche-Tard"])], [("operator", "tagged", ["Couche-Tard"])], [("name", "listed", ["couche_tard"])]],
    ),
    ("circle_k", [[("brand", "tagged", ["Circle K"])], [("name", "listed", ["circle_k"])]]),
    (
        "macs",
        [[("brand", "tagged", ["Mac's", "Macs"])], [("operator", "tagged", ["Mac's"])], [("name", "listed", ["macs"])]],
    ),
]
# type of a station by brand; "stored" and "listed" stand for the stored type and the type of the catalogue
FUEL_TYPE_RULES = {
    "loves": [
        (TRAVEL_PLAZA, [[("pin", "is", TRAVEL_STOP_PINS)]]),
        (CONVENIENCE_FUEL, [[("pinned", "is", ["true"])]]),
        (CONVENIENCE_FUEL, [[("words", "has", ["country store"]), ("words", "lacks", ["travel stop", "travel center"])]]),
        (TRAVEL_PLAZA, [[("words", "has", ["travel stop", "travel center"])]]),
        ("stored", [[("stored", "is", [TRAVEL_PLAZA, CONVENIENCE_FUEL])]]),
        ("listed", [[]]),
    ],
    "sister": [
        (TRAVEL_PLAZA, [[("official", "is", ["true"]), ("full", "is", ["true"])]]),
        (CONVENIENCE_FUEL, [[("official", "is", ["true"])]]),
        (CONVENIENCE_FUEL, [[("words", "like", [r"\bfuel only\b|\bcardlock\b"])]]),
        (CONVENIENCE_FUEL, [[("words", "like", [r"\bdealer\b"]), ("words", "lacks", ["travel center", "travel plaza"])]]),
        (TRAVEL_PLAZA, [[("words", "has", ["travel center", "travel plaza", "flying j travel"])]]),
        ("stored", [[("stored", "is", [TRAVEL_PLAZA, CONVENIENCE_FUEL])]]),
        ("listed", [[]]),
    ],
    "cefco": [
        (TRAVEL_PLAZA, [[("large", "is", ["true"])]]),
        (CONVENIENCE_FUEL, [[("large", "is", ["false"])]]),
        (TRAVEL_PLAZA, [[("words", "has", ["cefco kitchen", "cefco travel", "travel center", "travel plaza"])]]),
        ("stored", [[("stored", "is", [TRAVEL_PLAZA])]]),
        (CONVENIENCE_FUEL, [[]]),
    ],
}

# --- fixed values: campgrounds -------------------------------------------------------------------
COMMERCIAL_US = [
    r"\bkoa\b", r"\byogi\b", r"\bjellystone\b", r"\bthousand trails\b", r"\bescapees\b",
    r"\bgood sam\b", r"\bpassport america\b", r"\brv resort\b", r"\brv park\b",
    r"\btrailer park\b", r"\bhipcamp\b", r"\bglamping\b", r"\bcountry acres\b",
    r"\blakefront resort\b",
]
COMMERCIAL_CA = [
    r"\bkoa\b", r"\byogi\b", r"\bjellystone\b", r"\bhipcamp\b", r"\bglamping\b", r"\brv resort\b",
    r"\brv park\b", r"\btrailer park\b", r"\bcamping privé\b", r"\bprivate campground\b",
    r"\bterrain de camping privé\b",
]
GOVERNMENT_OPERATOR_CA = (
    "parks canada|parcs canada|bc parks|british columbia parks|alberta parks|ontario parks|parks ontario|"
    "saskatchewan parks|manitoba parks|sepaq|parc provincial|provincial park|ministry of environment|"
    "ministry of tourism"
)
FEDERAL_SOURCES = ["01-nps-poi", "02-usfs-recreation", "04-ridb"]
CAMPING_SOURCES_US = ["01-nps-poi", "02-usfs-recreation", "04-ridb", "03-osm"]
CAMPING_SOURCES_CA = ["01-parks-canada", "03-provincial-seed", "02-osm"]
KNOWN_MANAGERS = ["NPS", "USFS", "BLM", "State", "COE", "USFWS", "County", "City"]
MANAGER_CODES = {
    "NPS": 0, "USFS": 1, "BLM": 2, "State": 3, "COE": 4, "USFWS": 5, "County": 6, "City": 7,
    "Unknown": 8, "Federal": 9,
}
CAMP_TYPE_CODES = {"developed": 0, "dispersed": 1, "group": 2, "placeholder": 3}
DISPLAY_TIER_CODES = {"default": 0, "qa": 1, "excluded": 2}
CAMPING_UNIT_CATEGORIES = ["park", "monument", "preserve", "recreation"]
PITCH_NAMES_BY_CODE = {"JNP-POC": "Miette Campground"}
PITCH_NAMES_BY_SOURCE_NAME = {"Pocahontas": "Miette Campground", "Snaring": "Snaring River Campground"}

# --- fixed values: state and provincial parks ----------------------------------------------------
FEDERAL_SCOPE = (
    r"national park service|\bnps\b|u\.?s\.?\s*forest service|\busfs\b|bureau of land management|\bblm\b|"
    r"fish and wildlife|\busfws\b|army corps|parks canada|parcs canada|pc\.gc\.ca|national park of canada|"
    r"parc national du canada"
)
US_NAME_EXCLUDED = (
    r"\b(national park|national monument|national forest|national wildlife|national recreation area|"
    r"national seashore|national lakeshore|county park|city park|municipal park|regional park|metro park|"
    r"township park|state forest|state game land|state wildlife area|state fish hatchery|state nursery|"
    r"state natural area|state recreation area|wildlife management area|wildlife area|"
    r"waterfowl management area|game management area|fish hatchery|\bhatchery\b|nature preserve|"
    r"conservation area|heritage preserve|heritage conservation|cooperative wildlife|greenway|\bWMA\b|"
    r"\bWRDA\b)\b"
)
US_NAME_INCLUDED = (
    r"\bstate park\b|\bstate historic (site|park|area|monument|preserve|landmark)\b|"
    r"\bstate historical (site|park|area)\b|\bstate heritage (site|park)\b|\bstate memorial\b"
)
CA_NAME_EXCLUDED = (
    r"\b(national park|national forest|parc national|forêt nationale|county park|city park|municipal park|"
    r"regional park|provincial forest|provincial recreation area|conservation reserve|ecological reserve|"
    r"nature reserve|réserve faunique|wildlife management area|wildlife area)\b"
)
CA_NAME_INCLUDED = (
    r"\bprovincial park\b|\bparc provincial\b|\bprovincial historic (site|park)\b|"
    r"\bsite historique provincial\b|\bprovincial heritage (site|park)\b|\bprovincial marine park\b|"
    r"\bparc marin provincial\b"
)
PARK_TYPE_IN_NAME = (
    r"\b(state|provincial)\s+(park|historic|historical|heritage|memorial)\b|"
    r"\bsite\s+historique\s+provincial\b|\bparc\s+(provincial|marin\s+provincial)\b"
)
HISTORIC_NAME = (
    r"\b(historic site|historical site|historic park|historical park|heritage site|heritage park|memorial|"
    r"battlefield|monument)\b"
)
STATE_PARK_NAME = (
    r"\bstate park\b|\bstate historic\b|\bstate historical\b|\bstate heritage\b|\bstate memorial\b|"
    r"\bprovincial park\b|\bprovincial historic\b|\bparc provincial\b|\bsite historique provincial\b"
)
PROVINCIAL_AMENITY_OPERATOR = (
    GOVERNMENT_OPERATOR_CA
    + r"|novascotia\.ca/parks|parcsnb|newfoundlandlabrador\.com/parks"
)
PROVINCIAL_AMENITY_SITE = (
    r"bcparks\.ca|ontarioparks\.|albertaparks\.ca|sepaq\.com|novascotia\.ca/parks|parks\.saskatchewan\.ca"
)
STATE_AMENITY_OPERATOR = (
    "state park|state parks|dept of natural|dnr|provincial park|bc parks|ontario parks"
)
HUB_TITLE_EXCLUDED = (
    r"PADUS|FederalLands|E911|Green Book|Geoheritage|IndianReservation|NationalParkService|"
    r"Chesapeake Conservation|Detroit_MP|Oblique Aerial|RaceHispanic|nhgis|shapefile|tract_|USA_|"
    r"National park \(PADUS\)|Mining Claims|Detailed_Parks|MineClaims"
)
COUNT_AGREEMENT_RATIO = 1.35

# classes of tagged units: (ways of the gate, confidence, [((category, designation), ways)]); "title" stands for the
# unit's own title
UNIT_CLASSES = {
    "CA": [
        (
            [[("name", "like", [CA_NAME_INCLUDED])], [("blob", "like", [CA_NAME_INCLUDED])]],
            "name",
            [
                (("historic_site", "Site historique provincial"), [[("name", "like", ["site historique provincial"])]]),
                (("historic_site", "Provincial Heritage Park"), [[("name", "like", ["provincial heritage park"])]]),
                (("historic_site", "Provincial Historic Park"), [[("name", "like", ["provincial historic park"])]]),
                (
                    ("historic_site", "Provincial Historic Site"),
                    [[("name", "like", ["historic|heritage|historique"])], [("blob", "like", ["historic|heritage|historique"])]],
                ),
                (("park", "Provincial Park"), [[]]),
            ],
        ),
    ],
    "US": [
        (
            [[("name", "like", [US_NAME_INCLUDED])]],
            "name",
            [
                (("historic_site", "State Historical Park"), [[("name", "like", ["state historical park"])]]),
                (("historic_site", "State Historic Park"), [[("name", "like", ["state historic park"])]]),
                (("historic_site", "State Heritage Park"), [[("name", "like", ["state heritage park"])]]),
                (("historic_site", "State Memorial"), [[("name", "like", ["state memorial"])]]),
                (("historic_site", "State Historic Site"), [[("name", "like", ["historic|heritage|memorial|historical"])]]),
                (("park", "State Park"), [[]]),
            ],
        ),
        (
            [[("title", "like", ["state park|state historic"])]],
            "protection_title",
            [
                (("historic_site", "title"), [[("title", "like", ["historic"])]]),
                (("park", "title"), [[]]),
            ],
        ),
    ],
}

# --- fixed values: federal units -----------------------------------------------------------------
UNIT_TYPE_RANK = {
    "National Park": 100,
    "National Park and Preserve": 95,
    "National Monument": 90,
    "National Historical Park": 80,
    "National Historic Park": 80,
    "National Memorial": 70,
    "National Recreation Area": 60,
    "National Seashore": 60,
    "National Lakeshore": 60,
    "National Preserve": 50,
    "Park": 10,
}
UNIT_TYPE_RANK_DEFAULT = 40
BOUNDARY_TYPE_RANK = {
    "National Park": 100,
    "National Monument": 90,
    "National Memorial": 70,
    "National Preserve": 50,
    "Other Designation": 20,
}
BOUNDARY_UNIT_TYPES = [
    "National Park", "National Monument", "National Preserve", "Other Designation",
    "National Historical Park", "National Historical Park and Preserve", "National Historic Site",
    "International Historic Site", "National Recreation Area", "National Seashore",
    "National Lakeshore", "National Battlefield", "National Battlefield Park",
    "National Battlefield Site", "National Military Park", "National Historical Reserve",
    "Ecological and Historic Preserve", "National Recreation River", "National River",
    "National River and Recreation Area", "National Scenic River", "National Scenic Riverway",
    "Scenic and Recreational River", "Wild River", "Wild and Scenic River", "National Reserve", "Park",
]
BOUNDARY_UNIT_TYPES_EXCLUDED = [
    "National Memorial", "National Parkway", "Parkway", "National Historic Trail",
    "National Scenic Trail", "National Monument and Historic Shrine",
]
BOUNDARY_CATEGORIES = [
    "park", "monument", "preserve", "historic_park", "historic_site", "recreation", "affiliated",
    "other",
]
BOUNDARY_PLACE_TYPES_CA = [
    "National Park", "National Park Reserve", "National Historic Site",
    "National Marine Conservation Area", "National Marine Conservation Area Reserve",
]
SUPPLEMENTAL_UNIT_SKIPPED = (
    "national historic trail|national scenic trail|national geologic trail|affiliated area"
)
UNIT_STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC "
    "ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY VI PR GU AS MP"
).split(" ")

# --- fixed values: park amenities ----------------------------------------------------------------
CAMP_TIERS = ["developed", "backcountry", "primitive"]
AMENITY_KINDS = ["campground", "campsite", "picnic_area", "restroom", "parking", "visitor_center"]
POI_TYPE_CAMP_TIER = {
    "Campground": "developed",
    "RV Campground": "developed",
    "Cabin Campground": "developed",
    "Backcountry Campsite": "backcountry",
    "Backcountry Cabin": "backcountry",
    "Campsite": "backcountry",
    "Primitive Campground": "primitive",
    "Primitive Camping": "primitive",
    "Primitive Campsite": "primitive",
}
POI_TYPE_CAMP_AMBIGUOUS = ["Camping"]
POI_TYPE_PICNIC = {
    "Picnic Area": "area",
    "Picnic Shelter": "shelter",
    "Pavilion": "pavilion",
    "Grill": "grill",
    "Campfire Ring": "campfire_ring",
    "Picnic Table": "table",
}
POI_TYPE_RESTROOM = {
    "Restroom": "restroom",
    "Vault Toilet": "vault_toilet",
    "Flush Toilet": "flush_toilet",
    "Bathroom": "restroom",
    "Toilet": "toilet",
    "Pit Toilet": "pit_toilet",
    "Outhouse": "outhouse",
    "Floating Restroom": "floating_restroom",
    "Showers": "showers",
    "Shower": "shower",
}
FACILITY_WORD_KIND = {
    "picnic": "picnic_area",
    "picnic area": "picnic_area",
    "day use": "picnic_area",
    "toilet": "restroom",
    "washroom": "restroom",
    "restroom": "restroom",
    "comfort station": "restroom",
    "shower": "restroom",
}

# --- fixed values: pin labels and weekdays -------------------------------------------------------
UNIT_LABEL = (
    r"\b(north|south|east|west|central)\s+unit\b|\belkhorn(?:\s+ranch)?\b|\bisland\b|\bmainland\b|"
    r"\bma(?:in)?\s+island\b"
)
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

# --- fixed values: example corridors (route id, ordered lat/lon vertices) ------------------------
ROUTES = {
    "SW": [
        (32.3513, -95.3011), (35.222, -101.8313), (35.0844, -106.6504), (38.5733, -109.5498),
        (41.223, -111.9738), (43.615, -116.2023), (47.6062, -122.3321), (49.2827, -123.1207),
    ],
    "CO": [
        (32.3513, -95.3011), (35.222, -101.8313), (36.9025, -104.439), (38.5458, -106.9253),
        (41.223, -111.9738), (43.615, -116.2023), (47.6062, -122.3321), (49.2827, -123.1207),
    ],
    "SWY": [
        (32.3513, -95.3011), (35.222, -101.8313), (39.7392, -104.9903), (41.3114, -105.5911),
        (41.223, -111.9738), (43.615, -116.2023), (47.6062, -122.3321), (49.2827, -123.1207),
    ],
    "MT": [
        (32.3513, -95.3011), (35.222, -101.8313), (39.7392, -104.9903), (44.7972, -106.9562),
        (46.8721, -114.0089), (47.6588, -117.426), (47.6062, -122.3321), (49.2827, -123.1207),
    ],
}
ROUTE_STEP_FRACTION = 0.05
ROUTE_FEDERAL_MI = 65.0
ROUTE_OTHER_MI = 50.0
CORRIDOR_STEP_KM = 20.0
CORRIDOR_MI = 100.0
KM_PER_MILE = 1.60934
