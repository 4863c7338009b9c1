"""Fixed values of the payments model.

Everything in this module is a constant that must equal the values the
modelled pipeline uses, so results agree row for row. They are stated
plainly, in their natural order, and are not computed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — city dimension mapping (city, state, region, tier, is_metro)
# ---------------------------------------------------------------------------
CITY_MAPPING = [
    ("MUMBAI", "Maharashtra", "West", "Tier 1", True),
    ("DELHI", "Delhi", "North", "Tier 1", True),
    ("BENGALURU", "Karnataka", "South", "Tier 1", True),
    ("HYDERABAD", "Telangana", "South", "Tier 1", True),
    ("CHENNAI", "Tamil Nadu", "South", "Tier 1", True),
    ("KOLKATA", "West Bengal", "East", "Tier 1", True),
    ("PUNE", "Maharashtra", "West", "Tier 1", True),
    ("AHMEDABAD", "Gujarat", "West", "Tier 1", True),
    ("JAIPUR", "Rajasthan", "North", "Tier 2", False),
    ("SURAT", "Gujarat", "West", "Tier 2", False),
    ("LUCKNOW", "Uttar Pradesh", "North", "Tier 2", False),
    ("KANPUR", "Uttar Pradesh", "North", "Tier 2", False),
    ("NAGPUR", "Maharashtra", "West", "Tier 2", False),
    ("INDORE", "Madhya Pradesh", "West", "Tier 2", False),
    ("THANE", "Maharashtra", "West", "Tier 2", False),
    ("BHOPAL", "Madhya Pradesh", "West", "Tier 2", False),
    ("VISAKHAPATNAM", "Andhra Pradesh", "South", "Tier 2", False),
    ("PATNA", "Bihar", "East", "Tier 2", False),
    ("VADODARA", "Gujarat", "West", "Tier 2", False),
    ("GHAZIABAD", "Uttar Pradesh", "North", "Tier 2", False),
    ("LUDHIANA", "Punjab", "North", "Tier 2", False),
    ("AGRA", "Uttar Pradesh", "North", "Tier 2", False),
    ("NASHIK", "Maharashtra", "West", "Tier 2", False),
    ("FARIDABAD", "Haryana", "North", "Tier 2", False),
    ("MEERUT", "Uttar Pradesh", "North", "Tier 2", False),
    ("RAJKOT", "Gujarat", "West", "Tier 2", False),
    ("VARANASI", "Uttar Pradesh", "North", "Tier 2", False),
    ("SRINAGAR", "Jammu & Kashmir", "North", "Tier 2", False),
    ("AURANGABAD", "Maharashtra", "West", "Tier 2", False),
    ("DHANBAD", "Jharkhand", "East", "Tier 2", False),
    ("AMRITSAR", "Punjab", "North", "Tier 2", False),
    ("NAVI MUMBAI", "Maharashtra", "West", "Tier 2", False),
    ("ALLAHABAD", "Uttar Pradesh", "North", "Tier 2", False),
    ("RANCHI", "Jharkhand", "East", "Tier 2", False),
    ("HOWRAH", "West Bengal", "East", "Tier 2", False),
    ("COIMBATORE", "Tamil Nadu", "South", "Tier 2", False),
    ("JABALPUR", "Madhya Pradesh", "West", "Tier 2", False),
    ("GWALIOR", "Madhya Pradesh", "West", "Tier 2", False),
    ("VIJAYAWADA", "Andhra Pradesh", "South", "Tier 3", False),
    ("JODHPUR", "Rajasthan", "North", "Tier 3", False),
    ("MADURAI", "Tamil Nadu", "South", "Tier 3", False),
    ("RAIPUR", "Chhattisgarh", "West", "Tier 3", False),
    ("KOTA", "Rajasthan", "North", "Tier 3", False),
    ("GUWAHATI", "Assam", "East", "Tier 3", False),
    ("CHANDIGARH", "Chandigarh", "North", "Tier 3", False),
    ("SOLAPUR", "Maharashtra", "West", "Tier 3", False),
    ("HUBBALLI", "Karnataka", "South", "Tier 3", False),
    ("TIRUCHIRAPPALLI", "Tamil Nadu", "South", "Tier 3", False),
    ("BAREILLY", "Uttar Pradesh", "North", "Tier 3", False),
    ("MORADABAD", "Uttar Pradesh", "North", "Tier 3", False),
    ("MYSURU", "Karnataka", "South", "Tier 3", False),
    ("GURGAON", "Haryana", "North", "Tier 3", False),
    ("ALIGARH", "Uttar Pradesh", "North", "Tier 3", False),
    ("JALANDHAR", "Punjab", "North", "Tier 3", False),
    ("BHUBANESWAR", "Odisha", "East", "Tier 3", False),
    ("NOIDA", "Uttar Pradesh", "North", "Tier 3", False),
    ("THIRUVANANTHAPURAM", "Kerala", "South", "Tier 3", False),
    ("KOCHI", "Kerala", "South", "Tier 2", False),
    ("KOZHIKODE", "Kerala", "South", "Tier 3", False),
    ("SALEM", "Tamil Nadu", "South", "Tier 3", False),
    ("MIRA-BHAYANDAR", "Maharashtra", "West", "Tier 3", False),
    ("WARANGAL", "Telangana", "South", "Tier 3", False),
    ("GUNTUR", "Andhra Pradesh", "South", "Tier 3", False),
    ("BHIWANDI", "Maharashtra", "West", "Tier 3", False),
    ("SAHARANPUR", "Uttar Pradesh", "North", "Tier 3", False),
    ("GORAKHPUR", "Uttar Pradesh", "North", "Tier 3", False),
    ("BIKANER", "Rajasthan", "North", "Tier 3", False),
    ("AMRAVATI", "Maharashtra", "West", "Tier 3", False),
    ("JAMSHEDPUR", "Jharkhand", "East", "Tier 3", False),
    ("BHILAI", "Chhattisgarh", "West", "Tier 3", False),
    ("CUTTACK", "Odisha", "East", "Tier 3", False),
    ("FIROZABAD", "Uttar Pradesh", "North", "Tier 3", False),
    ("BHAVNAGAR", "Gujarat", "West", "Tier 3", False),
    ("DEHRADUN", "Uttarakhand", "North", "Tier 3", False),
    ("DURGAPUR", "West Bengal", "East", "Tier 3", False),
    ("ASANSOL", "West Bengal", "East", "Tier 3", False),
    ("NANDED", "Maharashtra", "West", "Tier 3", False),
    ("KOLHAPUR", "Maharashtra", "West", "Tier 3", False),
    ("AJMER", "Rajasthan", "North", "Tier 3", False),
    ("GULBARGA", "Karnataka", "South", "Tier 3", False),
    ("JAMNAGAR", "Gujarat", "West", "Tier 3", False),
    ("UJJAIN", "Madhya Pradesh", "West", "Tier 3", False),
    ("LONI", "Uttar Pradesh", "North", "Tier 3", False),
    ("SILIGURI", "West Bengal", "East", "Tier 3", False),
    ("JHANSI", "Uttar Pradesh", "North", "Tier 3", False),
    ("ULHASNAGAR", "Maharashtra", "West", "Tier 3", False),
    ("NELLORE", "Andhra Pradesh", "South", "Tier 3", False),
    ("JAMMU", "Jammu & Kashmir", "North", "Tier 3", False),
    ("SANGLI", "Maharashtra", "West", "Tier 3", False),
    ("MANGALURU", "Karnataka", "South", "Tier 3", False),
    ("ERODE", "Tamil Nadu", "South", "Tier 3", False),
    ("BELGAUM", "Karnataka", "South", "Tier 3", False),
    ("AMBATTUR", "Tamil Nadu", "South", "Tier 3", False),
    ("TIRUNELVELI", "Tamil Nadu", "South", "Tier 3", False),
    ("MALEGAON", "Maharashtra", "West", "Tier 3", False),
    ("GAYA", "Bihar", "East", "Tier 3", False),
    ("UDAIPUR", "Rajasthan", "North", "Tier 3", False),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — source-side city list as written into lake files
# (city, state, region, tier, is_metro). Kochi and Noida appear twice; the
# loader's city -> state lookup keeps the last entry of a name.
# ---------------------------------------------------------------------------
SOURCE_CITIES = [
    ("Mumbai", "Maharashtra", "West", "Tier 1", True),
    ("Delhi", "Delhi", "North", "Tier 1", True),
    ("Bengaluru", "Karnataka", "South", "Tier 1", True),
    ("Hyderabad", "Telangana", "South", "Tier 1", True),
    ("Chennai", "Tamil Nadu", "South", "Tier 1", True),
    ("Kolkata", "West Bengal", "East", "Tier 1", True),
    ("Pune", "Maharashtra", "West", "Tier 1", True),
    ("Ahmedabad", "Gujarat", "West", "Tier 1", True),
    ("Kochi", "Kerala", "South", "Tier 2", False),
    ("Jaipur", "Rajasthan", "North", "Tier 2", False),
    ("Surat", "Gujarat", "West", "Tier 2", False),
    ("Lucknow", "Uttar Pradesh", "North", "Tier 2", False),
    ("Kanpur", "Uttar Pradesh", "North", "Tier 2", False),
    ("Nagpur", "Maharashtra", "West", "Tier 2", False),
    ("Indore", "Madhya Pradesh", "West", "Tier 2", False),
    ("Thane", "Maharashtra", "West", "Tier 2", False),
    ("Bhopal", "Madhya Pradesh", "West", "Tier 2", False),
    ("Visakhapatnam", "Andhra Pradesh", "South", "Tier 2", False),
    ("Patna", "Bihar", "East", "Tier 2", False),
    ("Vadodara", "Gujarat", "West", "Tier 2", False),
    ("Ghaziabad", "Uttar Pradesh", "North", "Tier 2", False),
    ("Ludhiana", "Punjab", "North", "Tier 2", False),
    ("Agra", "Uttar Pradesh", "North", "Tier 2", False),
    ("Nashik", "Maharashtra", "West", "Tier 2", False),
    ("Faridabad", "Haryana", "North", "Tier 2", False),
    ("Meerut", "Uttar Pradesh", "North", "Tier 2", False),
    ("Rajkot", "Gujarat", "West", "Tier 2", False),
    ("Varanasi", "Uttar Pradesh", "North", "Tier 2", False),
    ("Srinagar", "Jammu & Kashmir", "North", "Tier 2", False),
    ("Aurangabad", "Maharashtra", "West", "Tier 2", False),
    ("Dhanbad", "Jharkhand", "East", "Tier 2", False),
    ("Amritsar", "Punjab", "North", "Tier 2", False),
    ("Navi Mumbai", "Maharashtra", "West", "Tier 2", False),
    ("Allahabad", "Uttar Pradesh", "North", "Tier 2", False),
    ("Ranchi", "Jharkhand", "East", "Tier 2", False),
    ("Howrah", "West Bengal", "East", "Tier 2", False),
    ("Coimbatore", "Tamil Nadu", "South", "Tier 2", False),
    ("Jabalpur", "Madhya Pradesh", "West", "Tier 2", False),
    ("Gwalior", "Madhya Pradesh", "West", "Tier 2", False),
    ("Vijayawada", "Andhra Pradesh", "South", "Tier 3", False),
    ("Jodhpur", "Rajasthan", "North", "Tier 3", False),
    ("Madurai", "Tamil Nadu", "South", "Tier 3", False),
    ("Raipur", "Chhattisgarh", "West", "Tier 3", False),
    ("Kota", "Rajasthan", "North", "Tier 3", False),
    ("Guwahati", "Assam", "East", "Tier 3", False),
    ("Chandigarh", "Chandigarh", "North", "Tier 3", False),
    ("Solapur", "Maharashtra", "West", "Tier 3", False),
    ("Hubballi", "Karnataka", "South", "Tier 3", False),
    ("Tiruchirappalli", "Tamil Nadu", "South", "Tier 3", False),
    ("Bareilly", "Uttar Pradesh", "North", "Tier 3", False),
    ("Moradabad", "Uttar Pradesh", "North", "Tier 3", False),
    ("Mysuru", "Karnataka", "South", "Tier 3", False),
    ("Gurgaon", "Haryana", "North", "Tier 3", False),
    ("Aligarh", "Uttar Pradesh", "North", "Tier 3", False),
    ("Jalandhar", "Punjab", "North", "Tier 3", False),
    ("Bhubaneswar", "Odisha", "East", "Tier 3", False),
    ("Noida", "Uttar Pradesh", "North", "Tier 3", False),
    ("Thiruvananthapuram", "Kerala", "South", "Tier 3", False),
    ("Kozhikode", "Kerala", "South", "Tier 3", False),
    ("Salem", "Tamil Nadu", "South", "Tier 3", False),
    ("Mira-Bhayandar", "Maharashtra", "West", "Tier 3", False),
    ("Warangal", "Telangana", "South", "Tier 3", False),
    ("Guntur", "Andhra Pradesh", "South", "Tier 3", False),
    ("Bhiwandi", "Maharashtra", "West", "Tier 3", False),
    ("Saharanpur", "Uttar Pradesh", "North", "Tier 3", False),
    ("Gorakhpur", "Uttar Pradesh", "North", "Tier 3", False),
    ("Bikaner", "Rajasthan", "North", "Tier 3", False),
    ("Amravati", "Maharashtra", "West", "Tier 3", False),
    ("Noida", "Uttar Pradesh", "North", "Tier 3", False),
    ("Jamshedpur", "Jharkhand", "East", "Tier 3", False),
    ("Bhilai", "Chhattisgarh", "West", "Tier 3", False),
    ("Cuttack", "Odisha", "East", "Tier 3", False),
    ("Firozabad", "Uttar Pradesh", "North", "Tier 3", False),
    ("Kochi", "Kerala", "South", "Tier 3", False),
    ("Bhavnagar", "Gujarat", "West", "Tier 3", False),
    ("Dehradun", "Uttarakhand", "North", "Tier 3", False),
    ("Durgapur", "West Bengal", "East", "Tier 3", False),
    ("Asansol", "West Bengal", "East", "Tier 3", False),
    ("Nanded", "Maharashtra", "West", "Tier 3", False),
    ("Kolhapur", "Maharashtra", "West", "Tier 3", False),
    ("Ajmer", "Rajasthan", "North", "Tier 3", False),
    ("Gulbarga", "Karnataka", "South", "Tier 3", False),
    ("Jamnagar", "Gujarat", "West", "Tier 3", False),
    ("Ujjain", "Madhya Pradesh", "West", "Tier 3", False),
    ("Loni", "Uttar Pradesh", "North", "Tier 3", False),
    ("Siliguri", "West Bengal", "East", "Tier 3", False),
    ("Jhansi", "Uttar Pradesh", "North", "Tier 3", False),
    ("Ulhasnagar", "Maharashtra", "West", "Tier 3", False),
    ("Nellore", "Andhra Pradesh", "South", "Tier 3", False),
    ("Jammu", "Jammu & Kashmir", "North", "Tier 3", False),
    ("Sangli", "Maharashtra", "West", "Tier 3", False),
    ("Mangaluru", "Karnataka", "South", "Tier 3", False),
    ("Erode", "Tamil Nadu", "South", "Tier 3", False),
    ("Belgaum", "Karnataka", "South", "Tier 3", False),
    ("Ambattur", "Tamil Nadu", "South", "Tier 3", False),
    ("Tirunelveli", "Tamil Nadu", "South", "Tier 3", False),
    ("Malegaon", "Maharashtra", "West", "Tier 3", False),
    ("Gaya", "Bihar", "East", "Tier 3", False),
    ("Udaipur", "Rajasthan", "North", "Tier 3", False),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — merchant category dimension
# (category_code, category_name, category_group, is_essential)
# ---------------------------------------------------------------------------
MERCHANT_CATEGORIES = [
    ("food_delivery", "Food Delivery", "Lifestyle", False),
    ("retail", "Retail Shopping", "Lifestyle", False),
    ("utilities", "Utilities & Bills", "Essential", True),
    ("travel", "Travel & Transport", "Travel", False),
    ("recharge", "Mobile Recharge", "Essential", True),
    ("p2p_transfer", "P2P Transfer", "Transfer", False),
    ("education", "Education", "Essential", True),
    ("healthcare", "Healthcare", "Essential", True),
    ("entertainment", "Entertainment", "Lifestyle", False),
    ("grocery", "Grocery", "Essential", True),
    ("fuel", "Fuel & Petrol", "Essential", True),
    ("insurance", "Insurance", "Financial", False),
    ("investment", "Investment & Mutual Funds", "Financial", False),
    ("gaming", "Gaming & Esports", "Lifestyle", False),
    ("govt_services", "Government Services", "Essential", True),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — amount range per merchant category at the source
# (category_code, min_amount, max_amount)
# ---------------------------------------------------------------------------
CATEGORY_AMOUNT_RANGES = [
    ("food_delivery", 49, 2500),
    ("retail", 50, 15000),
    ("utilities", 100, 8000),
    ("travel", 50, 25000),
    ("recharge", 19, 1499),
    ("p2p_transfer", 1, 100000),
    ("education", 500, 50000),
    ("healthcare", 100, 30000),
    ("entertainment", 99, 5000),
    ("grocery", 50, 5000),
    ("fuel", 100, 6000),
    ("insurance", 500, 75000),
    ("investment", 100, 200000),
    ("gaming", 9, 5000),
    ("govt_services", 50, 10000),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — payment app dimension (app_name, company, market_share_pct)
# ---------------------------------------------------------------------------
UPI_APPS = [
    ("phonepe", "Walmart", 48.0),
    ("google pay", "Google", 37.0),
    ("paytm", "One97 Comms", 8.0),
    ("bhim", "NPCI", 4.0),
    ("amazon pay", "Amazon", 3.0),
]

# FIXED VALUES — app names as written into lake files
SOURCE_APP_NAMES = ["PhonePe", "Google Pay", "Paytm", "BHIM", "Amazon Pay"]

# ---------------------------------------------------------------------------
# FIXED VALUES — payment type dimension (type_code, type_name)
# ---------------------------------------------------------------------------
PAYMENT_TYPES = [
    ("p2m", "Peer to Merchant"),
    ("p2p", "Peer to Peer"),
    ("bill_payment", "Bill Payment"),
    ("recharge", "Mobile Recharge"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — festival list of the calendar dimension (24 days)
# ---------------------------------------------------------------------------
CALENDAR_FESTIVALS = [
    ("2023-01-14", "Makar Sankranti"),
    ("2023-01-26", "Republic Day"),
    ("2023-03-08", "Holi"),
    ("2023-08-15", "Independence Day"),
    ("2023-08-30", "Raksha Bandhan"),
    ("2023-09-19", "Ganesh Chaturthi"),
    ("2023-10-24", "Dussehra"),
    ("2023-11-12", "Diwali"),
    ("2023-11-13", "Diwali Day 2"),
    ("2023-12-25", "Christmas"),
    ("2023-12-31", "New Year Eve"),
    ("2024-01-01", "New Year"),
    ("2024-01-22", "Ram Mandir Consecration"),
    ("2024-01-26", "Republic Day"),
    ("2024-03-25", "Holi"),
    ("2024-08-15", "Independence Day"),
    ("2024-08-19", "Raksha Bandhan"),
    ("2024-09-07", "Ganesh Chaturthi"),
    ("2024-10-02", "Gandhi Jayanti"),
    ("2024-10-12", "Dussehra"),
    ("2024-10-31", "Diwali"),
    ("2024-11-01", "Diwali Day 2"),
    ("2024-12-25", "Christmas"),
    ("2024-12-31", "New Year Eve"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — festival list behind the source rows' is_festival (41 days)
# ---------------------------------------------------------------------------
SOURCE_FESTIVALS = [
    ("2023-01-14", "Makar Sankranti"),
    ("2023-01-26", "Republic Day"),
    ("2023-03-08", "Holi"),
    ("2023-03-30", "Ram Navami"),
    ("2023-04-07", "Good Friday"),
    ("2023-04-14", "Ambedkar Jayanti"),
    ("2023-04-22", "Eid ul-Fitr"),
    ("2023-06-29", "Eid ul-Adha"),
    ("2023-08-15", "Independence Day"),
    ("2023-08-30", "Raksha Bandhan"),
    ("2023-09-07", "Janmashtami"),
    ("2023-09-19", "Ganesh Chaturthi"),
    ("2023-10-02", "Gandhi Jayanti"),
    ("2023-10-24", "Dussehra"),
    ("2023-11-12", "Diwali"),
    ("2023-11-13", "Diwali (Day 2)"),
    ("2023-11-27", "Guru Nanak Jayanti"),
    ("2023-12-25", "Christmas"),
    ("2023-12-31", "New Year Eve"),
    ("2024-01-01", "New Year"),
    ("2024-01-14", "Makar Sankranti"),
    ("2024-01-22", "Ram Mandir Consecration"),
    ("2024-01-26", "Republic Day"),
    ("2024-03-25", "Holi"),
    ("2024-04-09", "Ram Navami"),
    ("2024-04-11", "Eid ul-Fitr"),
    ("2024-04-14", "Ambedkar Jayanti / Tamil New Year"),
    ("2024-04-17", "Good Friday"),
    ("2024-06-17", "Eid ul-Adha"),
    ("2024-07-17", "Muharram"),
    ("2024-08-15", "Independence Day"),
    ("2024-08-19", "Raksha Bandhan"),
    ("2024-08-26", "Janmashtami"),
    ("2024-09-07", "Ganesh Chaturthi"),
    ("2024-10-02", "Gandhi Jayanti"),
    ("2024-10-12", "Dussehra"),
    ("2024-10-31", "Diwali"),
    ("2024-11-01", "Diwali (Day 2)"),
    ("2024-11-15", "Guru Nanak Jayanti"),
    ("2024-12-25", "Christmas"),
    ("2024-12-31", "New Year Eve"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — failure reasons, statuses, devices
# ---------------------------------------------------------------------------
FAILURE_REASONS = [
    "Insufficient funds",
    "Bank server timeout",
    "Invalid UPI PIN",
    "Transaction limit exceeded",
    "Receiver UPI ID not found",
    "Network error",
    "Duplicate transaction declined",
]
STATUSES = ["SUCCESS", "FAILED", "PENDING"]

# ---------------------------------------------------------------------------
# FIXED VALUES — calendar dimension range: [start, end), one row per day
# ---------------------------------------------------------------------------
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2025-01-01"

# ---------------------------------------------------------------------------
# FIXED VALUES — derived labels
# ---------------------------------------------------------------------------
# hour buckets: (first hour, last hour, label); any other hour (or NULL) -> LATE_NIGHT
TIME_OF_DAY_BUCKETS = [
    (5, 8, "Early Morning"),
    (9, 11, "Morning"),
    (12, 13, "Lunch"),
    (14, 16, "Afternoon"),
    (17, 19, "Evening"),
    (20, 22, "Night"),
]
LATE_NIGHT = "Late Night"

# amount buckets: (exclusive upper bound, label); the rest -> HIGH_VALUE
AMOUNT_BUCKETS = [
    (100, "Micro (<₹100)"),
    (500, "Small (₹100-500)"),
    (2000, "Medium (₹500-2K)"),
    (10000, "Large (₹2K-10K)"),
]
HIGH_VALUE = "High Value (>₹10K)"

# seasons by month number; other months -> "Winter"
SEASONS = [((3, 4, 5), "Summer"), ((6, 7, 8, 9), "Monsoon"), ((10, 11), "Autumn")]
DEFAULT_SEASON = "Winter"

# fiscal quarters (April-March year): (first month, last month, label); else "Q4"
FISCAL_QUARTERS = [(4, 6, "Q1"), (7, 9, "Q2"), (10, 12, "Q3")]
DEFAULT_FISCAL_QUARTER = "Q4"

# population bucket by tier
POPULATION_BUCKETS = [("Tier 1", "Large (>4M)"), ("Tier 2", "Medium (1-4M)")]
DEFAULT_POPULATION_BUCKET = "Small (<1M)"
TIERS = ["Tier 1", "Tier 2", "Tier 3"]

# surrogate key: token that stands for NULL before hashing, and field separator
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# incremental fact: rows newer than max(created_at) minus this lookback
LOOKBACK = "INTERVAL 1 HOUR"

# success-rate floor of the singular check, in percent
SUCCESS_RATE_FLOOR = 85

# lake: the city folder replaces these characters with "_"
LAKE_KEY_CHARS = " -"
# lake: id prefix of a transaction
TXN_PREFIX = "TXN"
# lake: unknown city -> state
UNKNOWN_STATE = "Unknown"
