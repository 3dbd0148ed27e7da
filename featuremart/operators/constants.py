"""Fixed values of the feature contract, stated once."""

# Window lengths in days, the event types counted per window,
# the session-length window and the order window.
DEFAULT_WINDOWS: tuple[int, ...] = (7, 30)
COUNTED_TYPES: tuple[str, ...] = ("page_view", "add_to_cart", "purchase")
LENGTH_WINDOW = 30
ORDER_WINDOW = 30
