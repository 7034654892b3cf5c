"""Column groups shared by the operators."""

# One sitting of one shift at one venue. Several capacity rows may share it
# (a template and a date override can both be live on the same day).
INSTANCE = ["venue_key_id", "persistent_id", "shift_date"]

MINUTES_PER_DAY = 24 * 60
