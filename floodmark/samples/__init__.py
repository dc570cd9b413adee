"""The sample tables in the roles of alerts and mitigations, and queries over them."""
