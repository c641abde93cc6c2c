"""Tables used by more than one test file."""

THREE11 = [
    (1, "1", "source conflict"), (2, "4", " source   conflict "), (3, "1", "consistent duplicate"),
    (4, "2", " consistent   duplicate "), (5, "3", "neutral unique"), (6, "4", "same V2 positive"),
    (7, "3", "same V2 negative"), (8, "", "missing rating"), (9, "invalid", "malformed rating"),
    (10, "3", "   "), (11, "5", "positive unique"),
]
V2 = [(101, "5", "same V2 positive"), (102, "1", "same V2 negative")]
