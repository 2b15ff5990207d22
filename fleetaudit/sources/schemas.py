"""Read schemas. They are explicit, since inference would differ between dumps."""

REFERENCES = "array<struct<name:string,type:string,id:string>>"
STATE = "struct<name:string>"
ACTION = "struct<name:string,failed:boolean,consumed_retries:int>"
STEP = "struct<name:string,step_status:string,start_time:bigint>"
RETRY = "struct<failed:boolean,consumed_retries:int>"
CONDITIONS = "map<string,variant>"
TRANSITIONS = f"array<struct<state_name:string,conditions:{CONDITIONS}>>"
STATES = f"array<struct<name:string,actions:array<string>,transitions:{TRANSITIONS}>>"
ISM_TEMPLATE = "array<struct<index_patterns:array<string>,priority:int,last_updated_time:bigint>>"

# Parts of a response that are objects with open content are kept as JSON text.
FIND_PAGE = (
    "struct<total:bigint,saved_objects:array<struct<type:string,id:string,attributes:string,"
    f"references:{REFERENCES},workspaces:array<string>,namespaces:array<string>,updated_at:string>>>"
)
RAW_SEARCH = "struct<hits:struct<hits:array<struct<_id:string,_source:string>>>>"
MANAGED_SEARCH = (
    "struct<hits:struct<hits:array<struct<_source:struct<managed_index:struct<index:string,policy_id:string,"
    "policy_seq_no:bigint,schedule:struct<interval:struct<period:int,unit:string>>>>>>>>"
)
INDEX_TEMPLATE = (
    "struct<index_patterns:array<string>,composed_of:array<string>,version:bigint,template:struct<settings:string>>"
)
TEMPLATE_LIST = "struct<index_templates:array<struct<name:string,index_template:string>>,component_templates:array<struct<name:string,component_template:string>>>"
TASK_NODES = (
    "struct<nodes:map<string,struct<name:string,tasks:map<string,struct<action:string,running_time_in_nanos:bigint,"
    "parent_task_id:string,description:string>>>>>"
)
PENDING = (
    "struct<tasks:array<struct<insert_order:bigint,priority:string,time_in_queue:string,time_in_queue_millis:bigint,"
    "source:string>>>"
)
DATA_STREAMS = (
    "struct<data_streams:array<struct<name:string,status:string,generation:bigint,template:string,"
    "indices:array<struct<index_name:string>>>>>"
)
STATS = "struct<indices:map<string,struct<total:struct<store:struct<size_in_bytes:bigint>>>>>"
SETTINGS = "struct<defaults:map<string,string>,transient:map<string,string>,persistent:map<string,string>>"
FIELD_CAPS = (
    "struct<indices:array<string>,fields:map<string,map<string,struct<aggregatable:boolean,searchable:boolean,"
    "indices:array<string>>>>>"
)
MAPPINGS = "map<string,struct<mappings:struct<properties:string>>>"
WORKSPACE = "struct<id:string,name:string,description:string>"
POLICY = (
    "struct<_id:string,_seq_no:bigint,_primary_term:bigint,policy:struct<policy_id:string,description:string,"
    f"default_state:string,states:{STATES},ism_template:{ISM_TEMPLATE}>>"
)
EXPORT_RECORD = f"struct<id:string,type:string,attributes:string,references:{REFERENCES}>"
