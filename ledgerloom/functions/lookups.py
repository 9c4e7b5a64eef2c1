"""Fixed values of the listing domain. They decide results, so they are given as they are."""

PROPERTY_TYPES = {
    "residential flats": "Apartment", "residential flat": "Apartment", "apartment": "Apartment", "apartments": "Apartment",
    "flat": "Apartment", "flats": "Apartment", "villa": "Villa", "villas": "Villa", "plot": "Plot", "plots": "Plot",
    "deen dayal plots": "Plot", "deen dayal plot": "Plot", "penthouse": "Penthouse", "studio": "Studio", "duplex": "Duplex",
    "independent floor": "Independent Floor", "independent floors": "Independent Floor", "floor": "Independent Floor",
    "commercial": "Commercial", "commercial property": "Commercial", "office": "Commercial", "shop": "Commercial",
    "sco": "SCO", "sco plot": "SCO", "sco plots": "SCO", "senior living": "Senior Living",
}
POSSESSION = {
    "underconstruction": "UNDER_CONSTRUCTION", "under construction": "UNDER_CONSTRUCTION", "new launch": "NEW_LAUNCH", "newlaunch": "NEW_LAUNCH",
    "upcoming": "NEW_LAUNCH", "ready": "READY_TO_MOVE", "ready to move": "READY_TO_MOVE", "readytomove": "READY_TO_MOVE",
    "completed": "READY_TO_MOVE", "resale": "READY_TO_MOVE",
}
CITIES = {"gurugram": "Gurgaon", "gurgaon": "Gurgaon", "bengaluru": "Bangalore", "bangalore": "Bangalore", "bombay": "Mumbai", "new delhi": "Delhi"}
EXPORT_CITIES = {"delhi": "Delhi NCR", "new delhi": "Delhi NCR"}
#: Cities looked for in free text; a longer name is tried before one that it contains.
TEXT_CITIES = ("Gurgaon", "Gurugram", "Greater Noida", "Noida", "New Delhi", "Delhi", "Mumbai", "Pune", "Bangalore", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Ahmedabad", "Jaipur", "Chandigarh", "Faridabad", "Ghaziabad", "Dubai")
#: Registration hints; a longer hint is tried before one that it contains.
RERA_STATES = {
    "MAHARERA": "Maharashtra", "HARERA": "Haryana", "HRERA": "Haryana", "UPRERA": "Uttar Pradesh", "K-RERA": "Karnataka", "KRERA": "Karnataka",
    "TNRERA": "Tamil Nadu", "RERARAJ": "Rajasthan", "GERA": "Gujarat", "WBHIRA": "West Bengal", "ORERA": "Odisha", "HARYANA": "Haryana",
}
RERA_PLACEHOLDERS = ("undefined", "null", "none", "na", "n/a", "applied", "pending")
PRICE_ON_REQUEST = ("on request", "price on request", "por", "call for price", "call for pricing", "price on call", "call for prices", "contact for price", "ask for price", "na", "n/a")
DATE_PLACEHOLDERS = ("on request", "na", "n/a", "applied")
#: Map pins that portals use where a project has none of its own.
PLACEHOLDER_POINTS = ((28.4595, 77.0266), (28.5355, 77.3910), (28.6139, 77.2090))
#: Slug tokens that tell phases and directions of a project apart.
PROJECT_MARKERS = ("east", "west", "north", "south", "phase", "i", "ii", "iii", "iv", "v", "vi")

# the bulk validator has maps of its own
BULK_CITIES = {"delhi": "Delhi NCR", "new delhi": "Delhi NCR", "ncr": "Delhi NCR", "gurugram": "Gurgaon", "gurgaon": "Gurgaon"}
BULK_TYPES = {"commercial property": "Commercial", "independent floors": "Independent Floor", "sco plots": "SCO", "sco plot": "SCO", "deen dayal plots": "Plot"}
BULK_POSSESSION = {"upcoming": "NEW_LAUNCH", "new launch": "NEW_LAUNCH", "newlaunch": "NEW_LAUNCH"}
ENUMS = {
    "listingType": (("BUY", "RENT", "NEW_PROJECT", "RESALE", "PG", "PLOT", "COMMERCIAL"), False),
    "status": (("ACTIVE", "INACTIVE", "SOLD", "RENTED"), False),
    "furnishing": (("UNFURNISHED", "SEMI_FURNISHED", "FULLY_FURNISHED"), True),
    "possessionStatus": (("READY_TO_MOVE", "UNDER_CONSTRUCTION", "NEW_LAUNCH"), True),
    "facing": (("NORTH", "SOUTH", "EAST", "WEST", "NORTH_EAST", "NORTH_WEST", "SOUTH_EAST", "SOUTH_WEST", "NORTH_SOUTH", "EAST_WEST"), True),
}

#: Paths of a listing portal that are no project pages.
RESERVED_SLUGS = (
    "about", "about-us", "blog", "blogs", "branded-residences", "career", "career-with-us", "careers", "contact", "contact-us", "developers",
    "disclaimer", "emi-calculator", "faq", "faqs", "home", "login", "news", "nri", "post-property", "privacy", "privacy-policy", "projects",
    "rental", "resale", "search", "signup", "site-map", "sitemap", "terms", "terms-and-conditions", "testimonials", "top-luxury-projects", "luxury-projects",
)
HUB_MARKER = "projects-in-"
EXCLUDED_PREFIXES = (
    "/projects/", "/project/", "/blog/", "/blogs/", "/news/", "/about", "/contact", "/privacy", "/terms", "/careers", "/api/", "/_next/", "/auth/",
    "/login", "/signup", "/post-property", "/property/", "/buy/", "/rent/", "/commercial/", "/dubai/", "/nri/", "/builders/", "/builder/", "/city/",
    "/cities/", "/search", "/sitemap", "/tags/", "/category/", "/projects-in-", "/rental/", "/developers/",
)
EXCLUDED_PATHS = ("/", "/projects", "/projects/residential", "/projects/residential/", "/projects/commercial", "/projects/commercial/")
PROJECT_PATH = r"^/[a-zA-Z0-9][a-zA-Z0-9\-]{1,120}/?$"
