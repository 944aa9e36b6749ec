"""Fixed values.

Everything in the block below must equal the source pipeline's values for
results to agree: limits, the synthetic-review templates, the three
adjective lists, the hospital type names and the ranges of generated
fields.  They are kept verbatim and in their original order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source pipeline; do not edit)
# ---------------------------------------------------------------------------

REAL_REVIEWS_LIMIT = 5
MIN_REVIEWS_PER_HOSPITAL = 100
SYNTHETIC_HOSPITALS_PER_CITY = 5
JDBC_BATCH_SIZE = 1000

SCORE_POSITIVE_ABOVE = 0.25
SCORE_NEGATIVE_BELOW = -0.25

SYNTHETIC_DATE_FIRST = "2020-01-01"
SYNTHETIC_DATE_LAST = "2024-12-31"
SYNTHETIC_MONTHS_AGO = (1, 12)
SYNTHETIC_REVIEW_RATING = (1, 5)
SYNTHETIC_RATINGS_TOTAL = (50, 5000)
SYNTHETIC_HOSPITAL_RATING = (1.0, 5.0)  # one decimal place
SYNTHETIC_LANGUAGE = "en"
DEFAULT_ORIGINAL_LANGUAGE = "en"
DEFAULT_ADDRESS = "N/A"
NO_DATE_TEXT = "N/A"
REAL_REVIEW_TYPE = "real"
FAKE_REVIEW_TYPE = "fake"

POSITIVE_TEMPLATES = [
    "The service was {adjective} and the staff were {adjective2}. I felt {adjective3} with the high quality care provided. The experience was truly unforgettable and exceeded all my expectations.",
    "I had an extremely {adjective} visit where the doctors, nurses, and every team member were {adjective2}. Their professionalism made me feel {adjective3} throughout my entire stay.",
    "My experience was absolutely {adjective} as the hospital was impeccably organized with {adjective2} staff. I was left feeling {adjective3} and grateful for the outstanding medical care.",
    "This hospital provided {adjective} service from beginning to end. The {adjective2} team ensured that I felt {adjective3} with every procedure and consultation.",
    "I was overwhelmed by the {adjective} level of care, thanks to the {adjective2} staff. Their dedication made me feel {adjective3} and very well taken care of.",
    "The entire service was {adjective} from start to finish. The {adjective2} professionals left me feeling {adjective3} and appreciative of their expertise.",
    "I had an {adjective} experience in every sense. The hospital’s {adjective2} staff ensured I felt {adjective3} and comfortable during my visit.",
    "From the moment I arrived, the {adjective} service and {adjective2} attitude of the team made me feel {adjective3} and confident in the care provided.",
    "The care was remarkably {adjective}, with {adjective2} professionals who made sure I felt {adjective3} and respected throughout my treatment.",
    "I experienced {adjective} service and {adjective2} warmth from every staff member. I left feeling {adjective3} and truly valued.",
    "The hospital boasts {adjective} facilities and a {adjective2} team. I felt {adjective3} due to the unparalleled care and attention given to me.",
    "Every step of the care was {adjective}. The {adjective2} team ensured a smooth experience, leaving me feeling {adjective3} and reassured.",
    "I was genuinely impressed by the {adjective} service and {adjective2} professionalism. It made me feel {adjective3} and optimistic about my recovery.",
    "The environment was {adjective} and the {adjective2} care team left me feeling {adjective3} throughout the entire process.",
    "I received {adjective} treatment that was second to none. The {adjective2} staff’s attention to detail made me feel {adjective3} and cared for.",
    "The dedication at this hospital is {adjective}. Their {adjective2} approach provided me with {adjective3} care in an incredibly supportive environment.",
    "I felt {adjective3} thanks to the {adjective2} care provided by a truly {adjective} hospital. The services here are outstanding in every way.",
    "The service was consistently {adjective} and the staff's {adjective2} commitment made me feel {adjective3}. Their care went well beyond my expectations.",
    "I was thoroughly impressed by the {adjective} environment and the {adjective2} professionals. I left feeling {adjective3} and ready to recommend this hospital.",
    "With {adjective} care and {adjective2} attention to every detail, I felt {adjective3} during every moment of my visit.",
]

NEUTRAL_TEMPLATES = [
    "The hospital was {adjective} overall, although there were some aspects that left me feeling {adjective2}. My experience was moderately {adjective3} and could use some improvement.",
    "My visit was {adjective}, with a few {adjective2} moments that made the service feel rather {adjective3}. It was neither exceptionally good nor bad.",
    "The service provided was {adjective}, and while some elements were {adjective2}, the overall experience felt {adjective3} without leaving a lasting impression.",
    "I found the hospital to be {adjective}, although there were some {adjective2} delays that resulted in a {adjective3} experience.",
    "Overall, my experience was {adjective}. The staff was {adjective2}, but certain procedures felt {adjective3} and lacked efficiency.",
    "The visit was {adjective} but somewhat unpredictable; while some aspects were {adjective2}, others felt {adjective3}.",
    "It was a {adjective} hospital environment. The service was {adjective2} on occasion, making the experience generally {adjective3}.",
    "I would describe the hospital as {adjective}, with a mix of {adjective2} strengths and {adjective3} delays affecting my overall experience.",
    "The hospital was {adjective}, and although some staff acted {adjective2}, the overall service was a bit {adjective3}.",
    "While the experience was {adjective}, there were moments that felt {adjective2}. In total, the care was somewhat {adjective3}.",
    "My experience was fairly {adjective}, with periodic {adjective2} service that made the experience come off as {adjective3}.",
    "The hospital maintained a {adjective} ambiance; however, slight {adjective2} inefficiencies resulted in a rather {adjective3} service.",
    "I found the overall service to be {adjective} with some {adjective2} moments that made it feel somewhat {adjective3} during my visit.",
    "It was an average, {adjective} experience with parts of the service being notably {adjective2}, leading to a predominantly {adjective3} impression.",
    "The care was {adjective} throughout, with fluctuations between {adjective2} attentiveness and {adjective3} pacing in the service.",
    "While the environment was {adjective}, I occasionally noted {adjective2} shortcomings that rendered the overall experience {adjective3}.",
    "Overall, the hospital service was {adjective}. Some parts of the experience were {adjective2}, which made it feel rather {adjective3}.",
    "I experienced a {adjective} visit that alternated between {adjective2} moments and a generally {adjective3} level of service.",
    "The hospital was {adjective} in its service. At times, the staff was {adjective2}, but overall the experience felt {adjective3}.",
    "There were elements of both {adjective} and {adjective2} service during my visit, leaving the overall experience as fairly {adjective3}.",
]

NEGATIVE_TEMPLATES = [
    "The service was {adjective} and {adjective2}. The staff were {adjective3}, and I felt very {adjective4} as a result of the poor care.",
    "My experience was extremely {adjective}. The hospital was {adjective2} overall, and the service was {adjective3}, leaving me feeling {adjective4} and disappointed.",
    "I was very {adjective} with my experience. The facility was {adjective2} and the service was {adjective3}, which left me feeling {adjective4} throughout my visit.",
    "The hospital proved to be {adjective}. The care was {adjective2} and insufficient, making the overall experience {adjective3} and leaving me {adjective4}.",
    "I felt utterly {adjective} during my stay. The staff was {adjective2} and the service was {adjective3}, so much so that I felt {adjective4}.",
    "The service was undeniably {adjective} with {adjective2} shortcomings. I was left feeling {adjective3} and truly {adjective4}.",
    "I had a {adjective} experience. The hospital was {adjective2} and the level of care was {adjective3}, leaving me feeling very {adjective4}.",
    "The overall service was {adjective} and completely {adjective2}. I felt {adjective3} and ultimately {adjective4} due to the inadequate treatment.",
    "My experience was {adjective}. The care was {adjective2}, and the staff behaved in a {adjective3} way, which ultimately made me feel {adjective4}.",
    "The hospital was {adjective} and the service {adjective2}. I felt extremely {adjective3} and ultimately {adjective4} due to the inadequate treatment.",
    "I was extremely {adjective} with the way I was treated. The service was {adjective2} and the facility felt {adjective3}, leaving me {adjective4}.",
    "The level of care was {adjective}. With {adjective2} service and {adjective3} staff, I felt profoundly {adjective4} during my visit.",
    "The overall service was {adjective}; the staff were {adjective2} and the approach was {adjective3}, making me feel very {adjective4}.",
    "Unfortunately, my experience was {adjective}. The hospital was {adjective2} and the service {adjective3}, which made me feel {adjective4} throughout.",
    "I encountered {adjective} service at the hospital. The staff were quite {adjective2}, and the care was {adjective3}, leaving me feeling {adjective4}.",
    "The experience was undeniably {adjective} and the staff seemed {adjective2}. With {adjective3} treatment, I ended up feeling {adjective4}.",
    "The facility provided {adjective} service, where the care was {adjective2} and the staff acted {adjective3}, causing me to feel {adjective4}.",
    "I felt very {adjective} during my stay. The hospital care was {adjective2} and overall service {adjective3}, making the experience extremely {adjective4}.",
    "The service was exceptionally {adjective} and the staff {adjective2}; however, the treatment was {adjective3} and left me feeling {adjective4}.",
    "Overall, my experience was {adjective}. With {adjective2} care and an approach that was {adjective3}, I felt undeniably {adjective4}.",
]

ADJECTIVES_POSITIVE = [
    "excellent", "outstanding", "superb", "wonderful", "amazing", "incredible", "fantastic", "perfect",
    "impressive", "phenomenal", "great", "marvelous", "top-notch", "super", "unbelievable",
    "exceptional", "spectacular", "first-rate", "awesome", "remarkable",
]

ADJECTIVES_NEUTRAL = [
    "mediocre", "average", "ordinary", "satisfactory", "standard", "fair", "acceptable", "decent",
    "unremarkable", "typical", "sufficient", "okay", "fine", "passable", "middling", "run-of-the-mill",
    "plain", "undistinguished", "unexceptional", "moderate",
]

ADJECTIVES_NEGATIVE = [
    "poor", "terrible", "disappointing", "unsatisfactory", "subpar", "abysmal", "horrible", "bad",
    "awful", "atrocious", "mediocre", "dismal", "frustrating", "unacceptable", "lousy", "unpleasant",
    "distressing", "horrendous", "unfortunate", "regrettable",
]

HOSPITAL_TYPES = ["General Hospital", "Medical Center", "Health Clinic", "Regional Hospital", "Community Hospital"]

# Template placeholders, filled in this order.
PLACEHOLDERS = ["{adjective}", "{adjective2}", "{adjective3}", "{adjective4}"]

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Our own choices (not inherited): the default envelope note and the label
# names used by the three-class lexicon scorer.
DEFAULT_DISCLAIMER = "For educational use only. Synthetic entries are generated for research purposes."
RATING_CLASSES = ("negative", "neutral", "positive")
SCORE_LABELS = ("Positive", "Negative", "Mixed")
