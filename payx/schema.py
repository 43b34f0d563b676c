"""Schemas and closed lists of the payment model."""

from __future__ import annotations

# Trailing windows in days (0: all), lenses, roles, buckets in order of magnitude.
WINDOWS = (("7d", 7), ("30d", 30), ("all", 0))
LENSES = ("all", "known")
ROLES = ("payer", "payee", "facilitator")
BANDS = ("dust", "micro", "small", "mid", "whale")
ENTITY_BUCKETS = ("1", "2-10", "11-100", "101-1000", "1001-100000", "100000+")
BATCH_BUCKETS = ("1", "2-10", "11-100", "100+")
CLASSES = ("otc", "sink", "fleet", "service", "tail")

# Event topics and call selectors of the token standard.
TOKEN = "0x833589fcd6edb6e08f4c7c32d4f71b54bda02913"
AUTHORIZATION_USED = "0x98de503528ee59b575ef0c0a2576a82497bfc029a5685b209e9ec333479b10a5"
AUTHORIZATION_CANCELED = "0x1cdd46ff242716cdaa72d159d339a485b3438398348d68f09d7c8c0a59353d81"
TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TRANSFER_SELECTORS = ("e3ee160e", "cf092995")
RECEIVE_SELECTORS = ("ef55bec6", "88b7ab63")
SOURCE, PROTOCOL, ASSET, DECIMALS = "base-collector", "x402", "USDC", 6
SELECTOR_NAMES = {"e3ee160e": ("transferWithAuthorization", "direct"), "cf092995": ("transferWithAuthorization", "direct"), "ef55bec6": ("receiveWithAuthorization", "direct"), "88b7ab63": ("receiveWithAuthorization", "direct"), "82ad56cb": ("aggregate3", "wrapper")}
CONTRACT_LABELS = {
    ("base", "0x833589fcd6edb6e08f4c7c32d4f71b54bda02913"): "USDC · Circle",
    ("base", "0xca11bde05977b3631167028862be2a173976ca11"): "Multicall3",
    ("base", "0x5ff137d4b0fdcd49dca30c7cf57e578a026d2789"): "EntryPoint (ERC-4337)",
}
#: Bounds of an authorization after this second, at the end of 2099, are taken as absent.
LAST_SECOND = 4102444800

# The wire format of a batch.
LOG = "struct<address:string,topic0:string,topic1:string,topic2:string,topic3:string,data:string,block_number:long,transaction_hash:string,transaction_index:int,log_index:int>"
TRANSACTION = "struct<hash:string,block_number:long,from:string,to:string,input:string,type:int,nonce:string,gas_used:string,effective_gas_price:string,max_fee_per_gas:string,max_priority_fee_per_gas:string,value:string,gas:string,l1_fee:string,l1_gas_used:string,l1_gas_price:string>"
BLOCK = "struct<number:long,timestamp:string,hash:string,base_fee_per_gas:string>"
BATCH = f"data array<struct<logs:array<{LOG}>,transactions:array<{TRANSACTION}>,blocks:array<{BLOCK}>>>, archive_height long, next_block long"
#: A landed file: a batch, the block that was asked for if known, and the text of a file that is none.
LANDED = f"{BATCH}, from_block long, _corrupt_record string"

#: A payment as it is stored, one row for each key (chain, tx_hash, log_index), partitioned by day.
PAYMENT = """chain string, tx_hash string, log_index int, block_number long, block_timestamp timestamp, day date, source string, protocol string, facilitator string, payer string, payee string,
payee_service_id long, asset string, token_address string, token_decimals int, token_symbol string, amount_raw decimal(38,0), amount_usdc decimal(38,6), value_hex string, asset_usd_at_time decimal(20,8),
auth_nonce string, method_selector string, settlement_kind string, self_settled boolean, called_contract string, input_calldata string, valid_after timestamp, valid_before timestamp, block_hash string, transaction_index int,
tx_type int, tx_nonce long, tx_value decimal(38,0), gas_used long, gas_limit long, effective_gas_price decimal(38,0), gas_cost_wei decimal(38,0), base_fee_per_gas decimal(38,0), max_fee_per_gas decimal(38,0),
max_priority_fee_per_gas decimal(38,0), l1_fee decimal(38,0), l1_gas_used decimal(38,0), l1_gas_price decimal(38,0)"""
