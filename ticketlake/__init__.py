"""ticketlake: customer-ticket analytics as lazy Spark DataFrame operators."""
