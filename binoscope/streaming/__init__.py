"""The batch operators on arriving rows: scoring is a plain stream projection, drift is checked per micro-batch."""
