"""Fixed values of the models. These must equal the source models' literals
for results to match, so they are listed plainly and in one place."""

# Login states.
CONSENT_ONLY = "Consent Only"
NO_CONSENT = "No Consent"
LOGGED_IN = "Logged-In"
MONTHLY = "Monthly Subscription"
YEARLY = "Yearly Subscription"
OTHER = "Other"

# Raw user_status values.
NOT_LOGGED_IN = "notLoggedIn"
NOT_SUBSCRIBED = "notSubscribed"
SUBSCRIBED = "subscribed"
NOT_SPECIFIED = "notSpecified"

# Consent status.
CONSENT = "Consent"

# Lower-cased raw statuses that classify as Consent Only.
CONSENT_ONLY_STATUSES = ("(not set)", "notloggedin", "notspecified")

# Lower-cased product-name fragments for monthly and yearly plans.
MONTHLY_MARKERS = ("monat", "month", "print")
YEARLY_MARKERS = ("jahr", "yearly")

# Loyalty segments named by the views-per-user override rule.
BRAND_LOVER = "Brand Lover"
LOYAL_READER = "Loyal Reader"
RETURNING_READER = "Returning Reader"
CASUAL_READER = "Casual Reader"

# Value types.
ADVERTISING = "Advertising"
SUBSCRIPTION = "Subscription"
