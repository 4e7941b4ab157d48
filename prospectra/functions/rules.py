"""Rules that results depend on. Everything in capitals here is a fixed value."""

from __future__ import annotations

# ---- fixed values: pages -------------------------------------------------------------------------------------------
PAGE_PATTERNS = {
    "leadership": ["leadership", "leadership-team", "leadership-profile", "leadership-profiles", "senior-leadership", "senior-management"],
    "management": ["management", "management-team", "management-profile", "management-profiles", "management-team-profiles"],
    "executive": ["executive", "executive-team", "executive-leadership", "executive-management", "executive-profiles"],
    "founder": ["founder", "founders", "founding-team", "co-founder", "cofounder", "co-founders"],
    "board": ["board", "board-of-directors", "board-directors", "directors-board", "board-members", "board-member"],
    "director": ["director", "directors", "director-profile", "director-profiles"],
    "team": ["our-team", "the-team", "team", "meet-the-team", "our-people", "people", "people-profiles", "team-members"],
    "contact": ["contact", "contact-us", "contactus", "get-in-touch", "reach-us", "talk-to-us", "contact-form"],
    "about": ["about", "about-us", "about-company", "company-profile", "company-overview", "who-we-are"],
}
PAGE_SCORES = {"leadership": 100, "management": 100, "executive": 100, "founder": 100, "board": 100, "director": 95, "team": 90, "contact": 90, "about": 70}
ANCHOR_PATTERNS = {
    "leadership": ["leadership", "leadership team", "senior leadership"],
    "management": ["management", "management team", "management profiles"],
    "executive": ["executive", "executive team", "executive leadership"],
    "founder": ["founder", "founders", "founding team"],
    "board": ["board", "board of directors", "board members"],
    "director": ["director", "directors"],
    "team": ["our team", "our people", "meet the team", "team members"],
    "contact": ["contact", "contact us", "get in touch", "reach us", "talk to us"],
    "about": ["about us", "about company", "company profile", "company overview", "who we are"],
}
SINGLE_SEGMENTS = {
    "leadership": "leadership", "management": "management", "management team": "management", "management profiles": "management",
    "executive": "executive", "executive team": "executive", "executive leadership": "executive", "board": "board",
    "board of directors": "board", "directors": "director", "founder": "founder", "founders": "founder", "our team": "team",
    "team": "team", "our people": "team", "people": "team", "contact": "contact", "contact us": "contact", "about": "about",
    "about us": "about", "company profile": "about", "who we are": "about",
}
COMMON_PATHS = [
    ("company-profile", "about"), ("corporate-profile", "about"), ("our-company", "about"), ("about-company", "about"), ("contactus", "contact"),
    ("leadership", "leadership"), ("about-us", "about"), ("about", "about"), ("company", "about"), ("who-we-are", "about"),
    ("management", "management"), ("management-team", "management"), ("executive-team", "executive"), ("executives", "executive"),
    ("our-team", "team"), ("team", "team"), ("our-people", "team"), ("people", "team"), ("board-of-directors", "board"),
    ("directors", "director"), ("founders", "founder"), ("founder", "founder"), ("contact-us", "contact"), ("contact", "contact"),
]
EXCLUDED_SEGMENTS = """
login signin sign-in signup sign-up register cart checkout shop store search privacy terms cookie cookies wp-admin wp-login
blog blogs news newsroom press media media-kit media-center media-centre article articles analyst analyst-speak analyst-reports reports
events event webinar webinars podcast podcasts career careers jobs job vacancy vacancies recruitment
products product services service solutions solution industries industry
resources case-studies case-study success-stories customer-stories downloads download
csr esg sustainability corporate-social-responsibility corporate-citizenship social-responsibility
alliances alliance partnerships partnership awards award recognitions recognition history innovation innovation-fund innovation-network
incubator business-incubator diversity diversity-inclusion diversity-equity-inclusion inclusion well-being wellbeing supplier-diversity
portfolio portfolio-companies our-portfolio-companies brand our-brand customer-speak clients-speak
locations location offices office tag tags category categories author authors
""".split()
EXCLUDED_KEYWORDS = """
award recognition privacy cookie alliance partner sustainab well-being wellbeing diversity inclusion history innovation
corporate-citizenship social-responsibility portfolio customer-speak clients-speak brand
""".split()
CONTENT_SIGNALS = """
license solution services service tool platform system product workspace cloud freshsales greythr jumpcloud microsoft google chrome
document project payroll identity device access task
""".split()
CONTACT_SEGMENTS = ["contact", "contact-us", "contactus", "get-in-touch", "reach-us", "talk-to-us"]
LEADERSHIP_PAGE_TYPES = ["leadership", "management"]
SKIPPED_LINKS = ["javascript:", "mailto:", "tel:", "sms:", "data:", "#"]
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml"]
MAX_URL_LENGTH, MIN_PAGE_SCORE, MAX_PAGES, MAX_CONTAINERS, MAX_ANCHORS, MAX_LINKS, MAX_CHILD_SITEMAPS = 2048, 55, 30, 12, 300, 600, 10
MAX_EMAILS, MAX_PHONES, MAX_CONTACT_LINKS = 20, 20, 20

# ---- fixed values: people ------------------------------------------------------------------------------------------
ROLES = [
    (r"\bchief\s+executive\s+officer\s+designate\b", "Chief Executive Officer Designate", "CXO"),
    (r"\bceo\s+designate\b", "CEO Designate", "CXO"),
    (r"\bchief\s+executive\s+officer\b", "Chief Executive Officer", "CXO"),
    (r"\bceo\b", "CEO", "CXO"),
    (r"\bchief\s+technology\s+officer\b", "Chief Technology Officer", "CXO"),
    (r"\bcto\b", "CTO", "CXO"),
    (r"\bchief\s+information\s+officer\b", "Chief Information Officer", "CXO"),
    (r"\bcio\b", "CIO", "CXO"),
    (r"\bchief\s+financial\s+officer\b", "Chief Financial Officer", "CXO"),
    (r"\bcfo\b", "CFO", "CXO"),
    (r"\bchief\s+operating\s+officer\b", "Chief Operating Officer", "CXO"),
    (r"\bcoo\b", "COO", "CXO"),
    (r"\bchief\s+marketing\s+officer\b", "Chief Marketing Officer", "CXO"),
    (r"\bcmo\b", "CMO", "CXO"),
    (r"\bchief\s+human\s+resources\s+officer\b", "Chief Human Resources Officer", "CXO"),
    (r"\bchro\b", "CHRO", "CXO"),
    (r"\bchief\s+people\s+officer\b", "Chief People Officer", "CXO"),
    (r"\bchief\s+data\s+officer\b", "Chief Data Officer", "CXO"),
    (r"\bchief\s+digital\s+officer\b", "Chief Digital Officer", "CXO"),
    (r"\bchief\s+strategy\s+and\s+risk\s+officer\b", "Chief Strategy and Risk Officer", "CXO"),
    (r"\bchief\s+strategy\s+officer\b", "Chief Strategy Officer", "CXO"),
    (r"\bchief\s+legal\s+officer\b", "Chief Legal Officer", "CXO"),
    (r"\bchief\s+compliance\s+officer\b", "Chief Compliance Officer", "CXO"),
    (r"\bchief\s+sustainability\s+officer\b", "Chief Sustainability Officer", "CXO"),
    (r"\bmanaging\s+director\b", "Managing Director", "Executive Leadership"),
    (r"\bexecutive\s+chairman\b", "Executive Chairman", "Board"),
    (r"\bvice\s+chairman\b", "Vice Chairman", "Board"),
    (r"\bchairman\b", "Chairman", "Board"),
    (r"\bexecutive\s+director\b", "Executive Director", "Executive Leadership"),
    (r"\blead\s+independent\s+director\b", "Lead Independent Director", "Board"),
    (r"\bindependent\s+director\b", "Independent Director", "Board"),
    (r"\bnon[-\s]?executive\s+director\b", "Non-Executive Director", "Board"),
    (r"\bpresident\b", "President", "Executive Leadership"),
    (r"\bco[-\s]?founder\b", "Co-Founder", "Founder"),
    (r"\bfounder\b", "Founder", "Founder"),
    (r"\bdirector\b", "Director", "Board"),
]
INVALID_NAMES = [
    "about us", "about", "leadership", "management", "management team", "leadership team", "investors", "investor", "top results", "results",
    "founders", "founder", "market leadership", "functional leadership", "our leadership", "our management", "board", "board of directors",
    "directors", "read more", "read bio", "view profile", "view bio", "profile", "careers", "contact", "contact us", "skip to main content", "menu", "home",
]
INVALID_NAME_PHRASES = ["about us", "top results", "market leadership", "functional leadership", "skip to", "read more", "view profile", "view bio", "investor relations", "contact us"]
NAVIGATION_WORDS = "home about leadership management investor investors contact careers results menu search login privacy terms".split()
ROLE_WORDS = "chief executive officer ceo cto cio cfo coo cmo chro president chairman director founder managing independent board".split()
SENTENCE_MARKERS = "is are was were has have and for with from to".split()
HONORIFICS = ["mr", "mrs", "ms", "miss", "dr", "prof"]
NAME_STOP_WORDS = ["mr", "mrs", "ms", "dr", "prof", "sir", "the"]
NAME_TAGS, ROLE_TAGS, HEADINGS = ["h2", "h3", "h4", "h5", "h6", "strong", "b"], ["p", "span", "div", "li", "small", "em"], ["h2", "h3", "h4", "h5", "h6"]
CARD_CLASSES = ["profile", "leader", "leadership", "executive", "management", "person", "team-member", "team_member", "bio"]
MAX_ROLE_CHARS, MAX_CARD_CHARS = 180, 500

# ---- fixed values: validation --------------------------------------------------------------------------------------
BLOCKED_PHRASES = ["read bio", "read more", "view profile", "view bio", "learn more", "know more", "click here", "adaptability starts here", "starts here"]
ROLE_NOISE = ["view profile", "view bio", "read bio", "read more", "learn more", "know more"]
SENTENCE_WORDS = "the starts here about leadership profile read more view learn contact careers".split()
ROLE_TERMS = ["chief", "officer", "executive", "president", "director", "chairman", "chairperson", "managing director", "vice president", "founder", "co-founder", "secretary", "general counsel"]
BOARD_ROLES = [
    "independent director", "lead independent director", "non[- ]executive director", "nonexecutive director", "chairman", "chairperson",
    "vice chairman", "vice chairperson", "executive chairman", "non[- ]executive chairman", "nonexecutive chairman",
]
CHIEF_ROLES = """
executive|operating|financial|technology|information|marketing|people|human\\s+resources|strategy|strategy\\s+and\\s+risk|legal|risk|data|product|commercial|customer|security|procurement|revenue|administrative|digital|sustainability|investment|information\\s+security
""".strip()
EXECUTIVE_ROLES = ["president", "executive director", "group director", "executive vice president", "senior vice president", "vice president", "general counsel", "company secretary"]
METHOD_BONUS = {"sibling_pair": 20, "semantic_card": 20, "tcs_executive_section": 20, "profile_link_card": 20, "structural_pair": 15}
SUPPLIED_TYPES = {"cxo": "CXO", "board": "Board", "executive leadership": "Executive Leadership", "executive": "Executive Leadership"}
EXPORT_TYPES = {"cxo": "CXO", "board": "Board", "executive leadership": "Executive Leadership"}
PRIORITIES = {"CXO": "HIGH", "Executive Leadership": "MEDIUM", "Board": "LOW"}

# ---- fixed values: enrichment and contacts -------------------------------------------------------------------------
PROFILE_TERMS = ["leadership", "management", "executive", "profile", "bio", "biography", "about", "team", "people", "directors"]
IGNORED_TERMS = ["privacy", "cookie", "terms", "careers", "job", "login", "signin", "contact", "investor-relations", "news", "press", "media"]
MATCH_TERMS = "chief officer ceo coo cfo cio cto cmo chro president director chairman chairperson".split() + ["managing director", "vice president", "founder", "secretary", "general counsel"]
MAX_PROFILES, MIN_PROFILE_SCORE = 8, 55
EMAIL_CLASS = "A-Za-z0-9.!#$%&'*+/=?^_`{|}~-"
PLACEHOLDER_DOMAINS = ["example.com", "example.org", "example.net"]
EMAIL_COLUMNS = ["email", "emails", "email_address", "email_addresses", "public_email", "company_email", "contact_email"]
PHONE_COLUMNS = ["phone", "phones", "phone_number", "phone_numbers", "telephone", "telephones", "public_phone", "company_phone", "contact_phone"]
COMPANY_COLUMNS = ["company_name", "company", "organisation", "organization"]
DOMAIN_COLUMNS = ["company_domain", "domain", "website_domain"]
URL_COLUMNS = ["page_url", "source_url", "url", "contact_page"]
LINK_COLUMNS = ["contact_url", "contact_link", "contact_page_url"]
MASTER_FIELDS = [
    "company_name", "company_domain", "person_name", "designation", "leadership_type", "lead_priority", "quality_score", "source_url", "verification_status",
    "verification_source", "enrichment_status", "enrichment_confidence", "professional_profile_url", "public_bio_url", "public_bio_excerpt",
    "public_location", "enrichment_method", "source_fetch_status",
]
ENRICHED_FIELDS = [
    "company_domain", "verification_status", "verification_source", "enrichment_status", "enrichment_confidence", "professional_profile_url",
    "public_bio_url", "public_bio_excerpt", "public_location", "enrichment_method", "source_fetch_status",
]
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
