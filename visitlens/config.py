"""Fixed values of the survey model.

Everything in this module is data, not logic: value domains, question
labels, column maps and token lists that reports must reproduce exactly.
They are kept together, in their natural order, so they can be reviewed and
edited as configuration. Callers may pass their own lists instead.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the source survey definitions)
# ---------------------------------------------------------------------------

# Likert answers (matched after lower + strip) and their scores.
LIKERT_MAP = {"poor": 0, "fair": 1, "good": 2, "very good": 3}
LIKERT_NA = "n/a"

# Columns never treated as Likert answers.
METADATA_COLUMNS = [
    "Respondent ID", "Collector ID", "Start Date", "End Date",
    "IP Address", "Email Address", "First Name", "Last Name",
]

# Text identity columns kept as text.
TEXT_IDENTITY_COLUMNS = ["Email Address", "First Name", "Last Name"]

# Footer column keywords (checked on the last header, case-insensitive).
FOOTER_KEYWORDS = ["important", "submit", "review", "typos"]

# Recommendation questions and their answer scores.
RECOMMENDATION_COLUMNS = [
    "How likely would you be to recommend this establishment? Response",
    "Based on this experience, how likely is it that you would return? Response",
]
RECOMMENDATION_SCORES = [("not very likely", 0), ("very likely", 2), ("quite likely", 1)]

# Speed bands: answer -> score.
DRINKS_ORDER_MAP = {
    "within three minutes": 3,
    "between three and four minutes": 2,
    "between four and five minutes": 1,
    "greater than five minutes": 0,
}
FOOD_ORDER_MAP = {
    "within 8 minutes": 3,
    "between 8 and 10 minutes": 2,
    "between 10 and 15 minutes": 1,
    "greater than 15 minutes": 0,
}
FOOD_SERVICE_MAP = {
    "within 12 minutes": 3,
    "between 12 and 15 minutes": 2,
    "between 15 and 18 minutes": 1,
    "greater than 18 minutes": 0,
}
HOT_BEVERAGE_MAP = {
    "within five minutes": 3,
    "between five and six minutes": 2,
    "between six and eight minutes": 1,
    "greater than eight minutes": 0,
}
SPEED_NA_TOKENS = ["n/a", "na"]
SPEED_COLUMN_MAPS = {
    "Speed of initial drinks order taking How quickly was your drinks order taken from arrival at bar?": DRINKS_ORDER_MAP,
    "Speed of initial drinks service How long did it take for your drinks to arrive from time of order?": DRINKS_ORDER_MAP,
    "Speed of food ordering How quickly was your food order taken from time of arrival at order point?": FOOD_ORDER_MAP,
    "Speed of food service How long did it take to receive your food from time of order?": FOOD_SERVICE_MAP,
    "Speed of any additional food service How long did it take to receive any subsequent food from time of order?": FOOD_ORDER_MAP,
    "Speed of hot beverage service How long did it take to receive your coffee/hot beverage from ordering?": HOT_BEVERAGE_MAP,
}

# Gender answers.
GENDER_COLUMN = "Please enter your details here: Gender:"
GENDER_MAP = {"female": "Female", "f": "Female", "male": "Male", "m": "Male"}

# Checkbox (word selection) question prefixes.
CHECKBOX_PREFIXES = ["Thinking about the staff", "Please select the words"]

# Column name fragments of recoded free-text columns (canonical names).
DATE_COLUMN = "date_of_your_visit_this_visit"
GUESTS_COLUMN = "please_enter_the_number_of_guests_in_your_party_response"
TIME_NAME_PARTS = ["time", "arrived"]
SPEND_NAME_PARTS = ["expenditure", "total"]

# Venue name cleaning: words removed from a file stem.
VENUE_STEM_PATTERNS = [r"v\d+(\.\d+)?", r"survey", r"iGUEST"]

# Report filters.
VISIT_DATE_FLOOR = "2023-01-01"
EXCLUDED_VENUE_WORDS = ["report", "ishop", "isales"]

# Performance bands (total score) and question ratings.
PERFORMANCE_BANDS = [(90, "Excellent"), (80, "Good"), (70, "Needs Attention")]
PERFORMANCE_BAND_ELSE = "Critical"
RATING_BANDS = [(90, "Very Good"), (75, "Good"), (50, "Fair")]
RATING_BAND_ELSE = "Poor"

# Visit groups by rank.
LATEST_RANK = 1
PREVIOUS_RANKS = (2, 11)
VISIT_GROUP_LATEST = "Latest Visit"
VISIT_GROUP_PREVIOUS = "Previous 10 Visits"
VISIT_GROUP_OLDER = "Older Visit"

# Tokens that mean "no comment".
NULL_TOKENS = ["nan", "na", "n/a", "null", "none"]

# Checkbox values that mean "selected" (compared after trimming spaces).
TRUTHY_TOKENS = ["1", "1.0", "true", "TRUE", "Yes", "yes"]

# Section score inputs: section -> (section score column, category columns).
SECTION_COLUMNS = {
    "service": ("service_score", [
        "service_pre_arrival_score", "service_arrival_score", "service_delivery_score",
        "service_timing_score", "service_departure_score"]),
    "selling": ("selling_score", [
        "selling_written_score", "selling_verbal_score", "selling_recommendation_score"]),
    "product": ("product_score", [
        "product_food_concept_score", "product_food_application_score",
        "product_food_output_score", "product_cold_drinks_score",
        "product_wine_score", "product_coffee_score"]),
    "environment": ("environment_score", [
        "env_bathroom_score", "env_smoking_score", "env_furnishings_score",
        "env_hygiene_score", "env_ambiance_score"]),
}

# Question score labels: (section label, category column, question label).
QUESTION_LABELS = [
    ("A - Service", "service_pre_arrival_score", "Pre-arrival"),
    ("A - Service", "service_arrival_score", "Arrival"),
    ("A - Service", "service_delivery_score", "Delivery"),
    ("A - Service", "service_timing_score", "Timing"),
    ("A - Service", "service_departure_score", "Departure"),
    ("B - Selling", "selling_written_score", "Written Information"),
    ("B - Selling", "selling_verbal_score", "Verbal Information"),
    ("B - Selling", "selling_recommendation_score", "Recommendations"),
    ("C - Product", "product_food_concept_score", "Food Concept"),
    ("C - Product", "product_food_application_score", "Food Application"),
    ("C - Product", "product_food_output_score", "Food Output"),
    ("C - Product", "product_cold_drinks_score", "Cold Drinks"),
    ("C - Product", "product_wine_score", "Wine"),
    ("C - Product", "product_coffee_score", "Coffee"),
    ("D - Environment", "env_bathroom_score", "Bathrooms"),
    ("D - Environment", "env_smoking_score", "Smoking Area"),
    ("D - Environment", "env_furnishings_score", "Furnishings"),
    ("D - Environment", "env_hygiene_score", "Hygiene"),
    ("D - Environment", "env_ambiance_score", "Ambiance"),
]

# Section breakdown labels: (section label, category column, category label).
BREAKDOWN_LABELS = [
    ("Service", "service_pre_arrival_score", "Pre-arrival"),
    ("Service", "service_arrival_score", "Arrival"),
    ("Service", "service_delivery_score", "Delivery"),
    ("Service", "service_timing_score", "Timing"),
    ("Service", "service_departure_score", "Departure"),
    ("Selling", "selling_written_score", "Written Information"),
    ("Selling", "selling_verbal_score", "Verbal Information"),
    ("Selling", "selling_recommendation_score", "Recommendations"),
    ("Product", "product_food_concept_score", "Food Concept"),
    ("Product", "product_food_application_score", "Food Application"),
    ("Product", "product_food_output_score", "Food Output"),
    ("Product", "product_cold_drinks_score", "Cold Drinks"),
    ("Product", "product_wine_score", "Wine"),
    ("Product", "product_coffee_score", "Coffee / Hot Beverages"),
    ("Environment", "env_bathroom_score", "Bathrooms"),
    ("Environment", "env_smoking_score", "Smoking Area"),
    ("Environment", "env_furnishings_score", "Furnishings / Equipment"),
    ("Environment", "env_hygiene_score", "Hygiene / Safety"),
    ("Environment", "env_ambiance_score", "Ambiance"),
]

# Staff behaviour metrics on a 0-3 scale: (column, metric label).
STAFF_SECTION = "Staff Behaviour"
STAFF_METRICS = [
    ("staff_warmth_score", "Staff warmth"),
    ("staff_presentation_score", "Staff presentation"),
    ("staff_grooming_score", "Staff grooming"),
    ("staff_attitude_score", "Staff attitude"),
    ("staff_teamwork_score", "Staff teamwork"),
    ("staff_clarity_score", "Staff clarity"),
]
STAFF_SCALE_MAX = 3

# Comment columns: (section, comment type, column name).
COMMENT_MAP = [
    ("Service", "Web / Social Media Comments", "web_and_social_media_sites_comments"),
    ("Service", "Website Comments", "web_site_comments"),
    ("Service", "Signage Comments", "signage_customer_information_comments"),
    ("Service", "Exterior Comments", "exterior_d_cor_lighting_environs_comments"),
    ("Service", "Welcome Comments", "welcome_comments"),
    ("Service", "Welcome Reception Comments", "welcome_reception_comments"),
    ("Service", "Staff Description", "staff_please_describe_your_server_including_name_if_possible_fo"),
    ("Service", "Staff Description", "staff_please_describe_your_server_s_including_name_if_possible_"),
    ("Service", "Service Quality Generic Comments", "service_quality_generic_comments"),
    ("Service", "Service Quality Comments", "service_quality_comments"),
    ("Service", "Service Quality Food Comments", "service_quality_food_comments"),
    ("Service", "Service Quality Beverage Comments", "service_quality_beverage_comments"),
    ("Service", "Timing Comments", "general_timing_comments"),
    ("Service", "Timing Comments", "timing_comments"),
    ("Service", "Speed of Service Comments", "speed_of_hot_beverage_service_comments_regarding_speed_of_food_"),
    ("Service", "Payment Comments", "payment_procedure_comments"),
    ("Service", "Farewell Comments", "farewell_comments"),
    ("Selling", "Written Information Comments", "information_written_comments"),
    ("Selling", "Verbal Information Comments", "information_verbal_comments"),
    ("Selling", "Recommendation Comments", "please_rate_how_successful_your_server_was_in_recommending_comm"),
    ("Product", "Food Concept Comments", "food_concept_comments_regarding_food_concept"),
    ("Product", "Food Application Comments", "food_application_comments_regarding_food_application"),
    ("Product", "Food Review", "food_output_please_write_a_review_of_all_the_food_you_sampled_i"),
    ("Product", "Food Review", "food_output_please_write_a_review_of_all_the_food_you_sampled_1"),
    ("Product", "Cold Drinks Comments", "cold_drinks_cocktails_beers_made_drinks_soft_drinks_details_and"),
    ("Product", "Cold Drinks Comments", "cold_drinks_cocktails_made_drinks_soft_drinks_details_and_descr"),
    ("Product", "Wine Comments", "wines_details_and_description_of_wines_sampled_and_any_addition"),
    ("Product", "Wine / Beer Comments", "wines_and_or_beers_details_and_description_of_wines_and_or_beer"),
    ("Product", "Coffee / Hot Beverage Comments", "coffee_hot_beverages_details_and_description_of_coffee_hot_beve"),
    ("Product", "Product Suggestions", "if_there_is_anything_you_would_love_to_see_added_to_the_product"),
    ("Environment", "Bathroom Comments", "lavatories_bathrooms_comments"),
    ("Environment", "Lavatories Comments", "lavatories_comments"),
    ("Environment", "Smoking Area Comments", "smoking_area_comments"),
    ("Environment", "Furnishings Comments", "furnishings_glass_and_equipment_comments"),
    ("Environment", "Furnishings Comments", "furnishings_glass_comments"),
    ("Environment", "Equipment / Safety Comments", "equipment_and_safety_comments"),
    ("Environment", "Hygiene and Safety Comments", "hygiene_and_safety_comments"),
    ("Environment", "Ambiance Comments", "ambiance_comments"),
    ("Environment", "Car Parking Comments", "car_parking_access_comments"),
    ("Overall", "Overall Summary", "please_provide_an_overall_summary_of_your_visit_in_approx_120_t"),
    ("Overall", "Overall Summary", "please_provide_an_overall_summary_of_your_visit_open_ended_resp"),
    ("Overall", "Expectation Gap", "in_what_ways_did_it_fail_to_meet_your_expectations_open_ended_r"),
    ("Overall", "Staff Improvement", "describe_any_ways_in_which_you_feel_the_staff_could_have_direct"),
    ("Overall", "Improvement Point 1", "please_list_up_to_three_bullet_points_summarising_things_you_fe"),
    ("Overall", "Improvement Point 2", "please_list_up_to_three_bullet_points_summarising_things_you__1"),
    ("Overall", "Improvement Point 3", "please_list_up_to_three_bullet_points_summarising_things_you__2"),
]

# Checkbox word columns: (word group, word label, column name).
WORD_MAP = [
    ("Staff Behaviour", "Adept", "thinking_about_the_staff_please_select_the_words_that_best_desc"),
    ("Staff Behaviour", "Awkward", "thinking_about_the_staff_please_select_the_words_that_best_de_1"),
    ("Staff Behaviour", "Confident", "thinking_about_the_staff_please_select_the_words_that_best_de_2"),
    ("Staff Behaviour", "Nervous", "thinking_about_the_staff_please_select_the_words_that_best_de_3"),
    ("Staff Behaviour", "Comfortable", "thinking_about_the_staff_please_select_the_words_that_best_de_4"),
    ("Staff Behaviour", "Resentful", "thinking_about_the_staff_please_select_the_words_that_best_de_5"),
    ("Staff Behaviour", "Empathetic", "thinking_about_the_staff_please_select_the_words_that_best_de_6"),
    ("Staff Behaviour", "With own agenda", "thinking_about_the_staff_please_select_the_words_that_best_de_7"),
    ("Staff Behaviour", "Perky", "thinking_about_the_staff_please_select_the_words_that_best_de_8"),
    ("Staff Behaviour", "Bored", "thinking_about_the_staff_please_select_the_words_that_best_de_9"),
    ("Staff Behaviour", "Engaging", "thinking_about_the_staff_please_select_the_words_that_best_d_10"),
    ("Staff Behaviour", "Aloof", "thinking_about_the_staff_please_select_the_words_that_best_d_11"),
    ("Service Behaviour", "Anticipatory", "please_select_the_words_that_best_describe_the_service_that_you"),
    ("Service Behaviour", "Reactive", "please_select_the_words_that_best_describe_the_service_that_y_1"),
    ("Service Behaviour", "Helpful", "please_select_the_words_that_best_describe_the_service_that_y_2"),
    ("Service Behaviour", "Unhelpful", "please_select_the_words_that_best_describe_the_service_that_y_3"),
    ("Service Behaviour", "Calm", "please_select_the_words_that_best_describe_the_service_that_y_4"),
    ("Service Behaviour", "Pressured", "please_select_the_words_that_best_describe_the_service_that_y_5"),
    ("Service Behaviour", "Precise", "please_select_the_words_that_best_describe_the_service_that_y_6"),
    ("Service Behaviour", "Clumsy", "please_select_the_words_that_best_describe_the_service_that_y_7"),
    ("Service Behaviour", "Attentive", "please_select_the_words_that_best_describe_the_service_that_y_8"),
    ("Service Behaviour", "Distracted", "please_select_the_words_that_best_describe_the_service_that_y_9"),
    ("Service Behaviour", "Active", "please_select_the_words_that_best_describe_the_service_that__10"),
    ("Service Behaviour", "Passive", "please_select_the_words_that_best_describe_the_service_that__11"),
]

# Number words understood by the guest-count recoder.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5,
    "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11,
    "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15,
    "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
    "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60,
    "seventy": 70, "eighty": 80, "ninety": 90,
    "hundred": 100, "thousand": 1000, "million": 1000000, "billion": 1000000000,
}

# Database identifier limit for generated column and table names.
MAX_IDENTIFIER_LEN = 63
