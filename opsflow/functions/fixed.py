"""Fixed values that results depend on, as given by the source systems."""

# US states and territories by postal code (fixed values).
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AS": "American Samoa", "AZ": "Arizona",
    "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "DC": "District Of Columbia", "FM": "Federated States Of Micronesia",
    "FL": "Florida", "GA": "Georgia", "GU": "Guam", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky",
    "LA": "Louisiana", "ME": "Maine", "MH": "Marshall Islands", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "MP": "Northern Mariana Islands",
    "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PW": "Palau", "PA": "Pennsylvania",
    "PR": "Puerto Rico", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota",
    "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VI": "Virgin Islands",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin",
    "WY": "Wyoming",
}

# Texts that precede a tracking number (fixed values; a tab follows the blank).
TRACKING_PREFIXES = ["PRO \t", "BOL \t", "FedEx Ground Economy \t"]

# Package value classes (fixed values).
VALUE_BOUNDS = [500, 1000, 2000, 5000]
VALUE_LABELS = ["$0-499.99", "$500-999.99", "$1000-1999.99", "$2000-4999.99", "$5000+"]

# Order of statuses when an order shows several (fixed values); others rank 6.
STATUS_RANKS = {"Completed": 1, "Shipping": 2, "Back Order": 3, "Open": 4, "Awaiting Payment": 5}
OTHER_STATUS_RANK = 6

# Open-shipment status names by code (fixed values).
SHIPMENT_STATUS = {"C": "Completed", "N": "Open", "I": "Invoiced", "F": "Confirmed"}

# Ship codes by shipping method (fixed values); a missing method ships by ground.
SHIP_CODES = {"GROUND": "FDXG", "2DAY": "FED2"}
SHIP_PRIORITY = "Fedex"
