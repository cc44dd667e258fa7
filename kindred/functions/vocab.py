"""Word lists and lookup tables of business records, as text."""

from __future__ import annotations

# Results depend on each of them.

LEGAL_SUFFIXES = """
incorporated corporation enterprises enterprise associates solutions services limited private center group
company co inc llc llp ltd pvt corp sarl
""".split()

#: Of two words, neither of which is removed alone.
LEGAL_PAIR = "प्राइवेट लिमिटेड"

SUFFIXES_BASELINE = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services center
""".split()

SUFFIXES_BLOCKING = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services service center solutions associates consulting consultants technologies tech
""".split()

SUFFIXES_MULTILINGUAL = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services center sarl sas eurl sa gmbh
""".split()

SUFFIXES_TIGHT = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services service center solutions associates consulting consultants technologies tech sa sarl sas sasu eurl ei
snc sci gie gmbh international india trading agency works auto general medical industries industry brothers sons
fils traders trader dealer dealers store stores association societe société comite comité ecole école clinique
maison
""".split()

SUFFIXES_SUPER = SUFFIXES_TIGHT + """
barbershop salon boutique shop
""".split()

SUFFIXES_PIPELINE = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services center solutions associates consulting technologies tech sa sarl sas sasu eurl gmbh international india
trading agency works auto general medical
""".split()

SUFFIXES_SHORT = """
inc incorporated llc llp ltd limited pvt private corp corporation co company enterprises enterprise group
services center sa sarl gmbh
""".split()

NAME_STOP_WORDS = """
store shop center centre services service group traders enterprise enterprises solutions tech technologies
technology mart retail agency global international national pvt ltd inc llc llp corp corporation company co
associates consulting consultants india american first new city state the bank market marketing trading finance
holdings capital management
""".split()

STREET_STOP_WORDS = """
road street drive avenue lane court suite floor unit north south east west building block phase
""".split()

ADDRESS_STOP_WORDS = """
road street drive avenue lane court suite floor unit north south east west building block phase near opp
opposite behind beside facing main cross plot nagar colony area dist district city state
""".split()

ADDRESS_TOKEN_STOPS = """
india usa us france near opp opposite road rd street st floor flr no plot ltd pvt rue av ave boulevard bd blvd
cedex
""".split()

FEATURE_STOP_WORDS = """
flat no plot shop gala floor bldg building wing room near opp opposite behind beside road rd street st lane ln
avenue ave nagar colony complex house h sector phase city west east north south rue av bd boulevard allee allée
chemin impasse place cours quai route rte residence batiment null undefined suite ste dr drive blvd ct court
""".split()

US_STATES = """
AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK
OR PA RI SC SD TN TX UT VT VA WA WV WI WY
""".split()

INDIA_PLACES = """
andhra arunachal assam bihar chhattisgarh goa gujarat haryana himachal jharkhand karnataka kerala madhya
maharashtra manipur meghalaya mizoram nagaland odisha orissa punjab rajasthan sikkim tamil nadu telangana
tripura uttar pradesh uttarakhand bengal delhi chandigarh pondicherry puducherry ladakh kashmir mumbai bangalore
bengaluru hyderabad ahmedabad chennai kolkata surat pune jaipur lucknow kanpur nagpur indore thane bhopal
visakhapatnam vizag patna vadodara baroda ghaziabad ludhiana agra nashik faridabad meerut rajkot varanasi
srinagar aurangabad dhanbad amritsar navi allahabad prayagraj ranchi howrah coimbatore jabalpur gwalior
vijayawada jodhpur madurai raipur kota guwahati solapur hubli dharwad bareilly moradabad mysore mysuru gurgaon
gurugram aligarh jalandhar tiruchirappalli trichy bhubaneswar salem warangal mira bhayandar thiruvananthapuram
trivandrum bhiwandi saharanpur gorakhpur guntur bikaner amravati noida jamshedpur bhilai cuttack firozabad kochi
cochin nellore bhavnagar dehradun durgapur asansol rourkela nanded kolhapur ajmer akola gulbarga kalaburagi
jamnagar ujjain loni siliguri jhansi ulhasnagar jammu sangli mangalore mangaluru erode belgaum belagavi ambattur
tirunelveli malegaon gaya udaipur kakinada davanagere kozhikode calicut rajahmundry bokaro bellary patiala
agartala bhagalpur muzaffarnagar latur dhule tirupati rohtak korba bhilwara berhampur muzaffarpur ahmednagar
mathura kollam avadi kadapa bilaspur satara bijapur vijayapura shivamogga shimoga chandrapur junagadh ambala
karauli mirzapur abohar khordha
""".split()

FRANCE_PLACES = """
auvergne rhone alpes bretagne bourgogne normandie occitanie aquitaine nouvelle alsace lorraine champagne ardenne
picardie languedoc roussillon provence cote dazur limousin poitou charentes franche comte ile france hauts loire
centre corse paris marseille lyon toulouse nice nantes montpellier strasbourg bordeaux lille rennes reims toulon
etienne havre grenoble dijon angers nimes villeurbanne clermont ferrand mans aix brest tours amiens limoges
annecy perpignan boulogne billancourt metz besancon orleans argenteuil rouen montreuil mulhouse caen nancy
tourcoing roubaix nanterre vitry seine avignon creteil dunkerque poitiers asnieres versailles colombes nazaire
herblain teste buch aubervilliers aulnay courbevoie cherbourg calais rochelle beziers
""".split()

INDIA_STATE_ALIASES = {
    "rj": "rajasthan",
    "rajasthan": "rajasthan",
    "राजस्थान": "rajasthan",
    "dl": "delhi",
    "delhi": "delhi",
    "new delhi": "delhi",
    "दिल्ली": "delhi",
    "mh": "maharashtra",
    "maharashtra": "maharashtra",
    "महाराष्ट्र": "maharashtra",
    "wb": "bengal",
    "west bengal": "bengal",
    "bengal": "bengal",
    "पश्चिम बंगाल": "bengal",
    "ka": "karnataka",
    "karnataka": "karnataka",
    "ಕರ್ನಾಟಕ": "karnataka",
    "tn": "tamil nadu",
    "tamil": "tamil nadu",
    "தமிழ்நாடு": "tamil nadu",
    "up": "uttar pradesh",
    "uttar": "uttar pradesh",
    "उत्तर प्रदेश": "uttar pradesh",
    "ts": "telangana",
    "tg": "telangana",
    "telangana": "telangana",
    "तेलंगाना": "telangana",
    "ap": "andhra pradesh",
    "andhra": "andhra pradesh",
    "आंध्र प्रदेश": "andhra pradesh",
    "mp": "madhya pradesh",
    "madhya": "madhya pradesh",
    "मध्य प्रदेश": "madhya pradesh",
    "gj": "gujarat",
    "gujarat": "gujarat",
    "ગુજરાત": "gujarat",
    "hr": "haryana",
    "haryana": "haryana",
    "हरियाणा": "haryana",
    "kl": "kerala",
    "kerala": "kerala",
    "केरल": "kerala",
    "pb": "punjab",
    "punjab": "punjab",
    "पंजाब": "punjab",
    "or": "odisha",
    "odisha": "odisha",
    "orissa": "odisha",
    "ओडिशा": "odisha",
    "jh": "jharkhand",
    "jharkhand": "jharkhand",
    "as": "assam",
    "assam": "assam",
    "br": "bihar",
    "bihar": "bihar",
    "बिहार": "bihar",
    "ut": "uttarakhand",
    "uttarakhand": "uttarakhand",
    "ch": "chandigarh",
    "chandigarh": "chandigarh",
    "ga": "goa",
    "goa": "goa",
}

CITY_SYNONYMS = {
    "bengaluru": "bangalore",
    "bangalore": "bangalore",
    "gurugram": "gurgaon",
    "gurgaon": "gurgaon",
    "mumbai": "mumbai",
    "bombay": "mumbai",
    "chennai": "chennai",
    "madras": "chennai",
    "kolkata": "kolkata",
    "calcutta": "kolkata",
    "prayagraj": "allahabad",
    "allahabad": "allahabad",
    "varanasi": "varanasi",
    "banaras": "varanasi",
    "kashi": "varanasi",
    "visakhapatnam": "vizag",
    "vizag": "vizag",
    "mysuru": "mysore",
    "mysore": "mysore",
    "kochi": "cochin",
    "cochin": "cochin",
    "vadodara": "baroda",
    "baroda": "baroda",
    "thiruvananthapuram": "trivandrum",
    "trivandrum": "trivandrum",
    "kozhikode": "calicut",
    "calicut": "calicut",
    "belagavi": "belgaum",
    "belgaum": "belgaum",
    "hubballi": "hubli",
    "hubli": "hubli",
}

STATE_CODES = {
    "maharashtra": "MH",
    "mh": "MH",
    "mumbai": "MH",
    "pune": "MH",
    "nagpur": "MH",
    "nashik": "MH",
    "thane": "MH",
    "tamil nadu": "TN",
    "tamilnadu": "TN",
    "tn": "TN",
    "chennai": "TN",
    "coimbatore": "TN",
    "madurai": "TN",
    "karnataka": "KA",
    "ka": "KA",
    "bangalore": "KA",
    "bengaluru": "KA",
    "mysore": "KA",
    "hubli": "KA",
    "delhi": "DL",
    "new delhi": "DL",
    "dl": "DL",
    "telangana": "TS",
    "ts": "TS",
    "tg": "TS",
    "hyderabad": "TS",
    "secunderabad": "TS",
    "andhra pradesh": "AP",
    "andhra": "AP",
    "ap": "AP",
    "visakhapatnam": "AP",
    "vijayawada": "AP",
    "gujarat": "GJ",
    "gj": "GJ",
    "ahmedabad": "GJ",
    "surat": "GJ",
    "vadodara": "GJ",
    "rajkot": "GJ",
    "west bengal": "WB",
    "bengal": "WB",
    "wb": "WB",
    "kolkata": "WB",
    "howrah": "WB",
    "uttar pradesh": "UP",
    "up": "UP",
    "lucknow": "UP",
    "kanpur": "UP",
    "noida": "UP",
    "varanasi": "UP",
    "agra": "UP",
    "haryana": "HR",
    "hr": "HR",
    "gurgaon": "HR",
    "gurugram": "HR",
    "faridabad": "HR",
    "rajasthan": "RJ",
    "rj": "RJ",
    "jaipur": "RJ",
    "jodhpur": "RJ",
    "kota": "RJ",
    "kerala": "KL",
    "kl": "KL",
    "kochi": "KL",
    "thiruvananthapuram": "KL",
    "kozhikode": "KL",
    "punjab": "PB",
    "pb": "PB",
    "ludhiana": "PB",
    "amritsar": "PB",
    "jalandhar": "PB",
    "madhya pradesh": "MP",
    "mp": "MP",
    "indore": "MP",
    "bhopal": "MP",
    "gwalior": "MP",
    "odisha": "OR",
    "or": "OR",
    "orissa": "OR",
    "bhubaneswar": "OR",
    "cuttack": "OR",
    "bihar": "BR",
    "br": "BR",
    "patna": "BR",
    "assam": "AS",
    "as": "AS",
    "guwahati": "AS",
    "chandigarh": "CH",
    "ch": "CH",
    "jharkhand": "JH",
    "jh": "JH",
    "ranchi": "JH",
    "dhanbad": "JH",
    "chhattisgarh": "CG",
    "cg": "CG",
    "raipur": "CG",
    "uttarakhand": "UK",
    "uk": "UK",
    "dehradun": "UK",
    "goa": "GA",
    "ga": "GA",
}

STATE_KEYWORDS = {
    "MH": ["maharashtra", "mumbai", "pune", "nagpur", "thane", "nashik", "aurangabad", "solapur", "kolhapur", "amravati", "navi mumbai", "महाराष्ट्र"],
    "DL": ["delhi", "new delhi", "south delhi", "north delhi", "west delhi", "east delhi", "delhi ncr", "दिल्\u200dली", "नई दिल्ली"],
    "KA": ["karnataka", "bangalore", "bengaluru", "mysore", "mysuru", "hubli", "dharwad", "mangalore", "mangaluru", "belgaum", "belagavi", "ಕರ್ನಾಟಕ"],
    "TN": ["tamil nadu", "tamilnadu", "chennai", "coimbatore", "madurai", "tiruchirappalli", "trichy", "salem", "tirunelveli", "erode", "தமிழ்நாடு"],
    "GJ": ["gujarat", "ahmedabad", "surat", "vadodara", "baroda", "rajkot", "bhavnagar", "jamnagar", "ગુજરાત"],
    "UP": ["uttar pradesh", "noida", "greater noida", "lucknow", "kanpur", "ghaziabad", "agra", "varanasi", "meerut", "allahabad", "prayagraj", "bareilly", "aligarh", "moradabad", "saharanpur", "gorakhpur", "firozabad", "jhansi", "muzaffarnagar", "mathura", "उत्तर प्रदेश"],
    "WB": ["west bengal", "bengal", "kolkata", "howrah", "durgapur", "asansol", "siliguri", "পশ্চিমবঙ্গ"],
    "RJ": ["rajasthan", "jaipur", "jodhpur", "kota", "bikaner", "ajmer", "udaipur", "bhilwara", "राजस्थान"],
    "TS": ["telangana", "hyderabad", "secunderabad", "warangal"],
    "AP": ["andhra pradesh", "visakhapatnam", "vizag", "vijayawada", "guntur", "nellore", "kakinada", "tirupati"],
    "KL": ["kerala", "kochi", "cochin", "thiruvananthapuram", "trivandrum", "kozhikode", "calicut", "kollam", "கேரளா", "കേരളം"],
    "MP": ["madhya pradesh", "indore", "bhopal", "jabalpur", "gwalior", "ujjain"],
    "HR": ["haryana", "gurgaon", "gurugram", "faridabad", "panipat", "ambala", "rohtak", "hisar", "karnal", "sonipat"],
    "PB": ["punjab", "ludhiana", "amritsar", "jalandhar", "patiala", "bathinda", "ਪੰਜਾਬ"],
    "BR": ["bihar", "patna", "gaya", "bhagalpur", "muzaffarpur", "बिहार"],
    "OD": ["odisha", "orissa", "bhubaneswar", "cuttack", "rourkela", "berhampur", "ଓଡ଼ିଶା"],
}

MULTI_WORD_STATES = ["tamil nadu", "andhra pradesh", "west bengal", "uttar pradesh", "madhya pradesh", "new delhi"]

MAIL_HOSTS = """
gmail.com yahoo.com hotmail.com outlook.com rediffmail.com icloud.com aol.com
""".split()
